"""Vectorised text kernel shared by the Arrow-backed operators.

Words are the runs of bytes outside ``[\\x20\\x09-\\x0D]`` (optionally after
A-Z are lower-cased), which are the bytes ``bytes.split()`` splits at.  Words
and shingles are identified by 64-bit hashes.  A word's hash folds its bytes in
eight at a time through a non-linear bijection (longer words than LONG are
hashed by blake2b), so no pattern of letters makes words collide; two given
ones agree with probability 2**-64.  Where a corpus has so many that some pair
would agree by chance, callers take a second hash of another seed beside it.
"""

from __future__ import annotations

import ctypes
import hashlib

import numpy as np
import pyarrow as pa
import zstandard

U = np.uint64
_rng = np.random.default_rng(20240229)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_WORD = ~_BLANK
_SEEDS = _rng.integers(0, 2**63, 4, dtype=U)
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=U)
#: Bytes up to which a word is hashed together with others.
LONG = 256


def tidy() -> None:
    """Give freed memory back to the system: a worker process outlives its tasks."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


_libc = ctypes.CDLL(None)
_remembered: dict[str, dict] = {}


def remembered(operator: str = "") -> dict:
    """What an operator keeps in a worker process between its tasks; what others kept there is given back."""
    others = [k for k in _remembered if k != operator]
    for k in others:
        del _remembered[k]
    if others:
        tidy()
    return _remembered.setdefault(operator, {}) if operator else {}


def tidied(f):
    """A function of Arrow tables that tidies up before and behind itself."""

    def run(*args):
        remembered()
        try:
            return f(*args)
        finally:
            tidy()

    # Spark counts the parameters of what it is given
    return (lambda table: run(table)) if f.__code__.co_argcount == 1 else run


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def texts(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = 1 << 20):
    """(first, last) rows of pieces of about `limit` bytes; a row is never cut."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of all rows start and end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = _WORD[data]
    edge = np.empty(len(data), bool)
    edge[0] = True
    np.logical_not(word[:-1], out=edge[1:])
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    edge[inner] = True
    start = np.flatnonzero(word & edge)
    edge[:-1] = ~word[1:]
    edge[-1] = True
    edge[inner - 1] = True
    return start, np.flatnonzero(word & edge) + 1


def hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end)."""
    size = end - start
    out = mix(size.astype(U) * U(0x9E3779B97F4A7C15) ^ _SEEDS[seed])
    padded = np.append(data, np.zeros(8, np.uint8))
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    left = None  # all, at first
    for at in range(0, LONG, 8):
        if at:
            left = np.flatnonzero((size > at) & (size <= LONG)) if left is None else left[size[left] > at]
            if not len(left):
                break
        own = slice(None) if left is None else left
        out[own] = mix((out[own] ^ (eight[start[own] + at] & _KEEP[np.minimum(size[own] - at, 8)])) * U(0xD6E8FEB86659FD93))
    for k in np.flatnonzero(size > LONG):
        digest = hashlib.blake2b(data[start[k] : end[k]], digest_size=8, salt=bytes([seed])).digest()
        out[k] = int.from_bytes(digest, "little")
    return out


def words(data: np.ndarray, offsets: np.ndarray, lower: bool, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in order, and where each row's words begin (rows + 1)."""
    start, end = spans(data, offsets)
    return hashed(_LOWER[data] if lower else data, start, end, seed), np.searchsorted(start, offsets)


def fold(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of what a and b stand for, one behind the other."""
    return mix(a * U(0xD6E8FEB86659FD93) + b)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word runs that begin at each word but the last n - 1, folded from runs of 1, 2, 4 and so on."""
    m = len(hashes) - n + 1
    if m <= 0 or n <= 0:
        return np.zeros(0, U)
    out, covered, run, width = None, 0, hashes, 1
    while True:
        if n & width:
            part = run[covered : covered + m]
            out = part if out is None else fold(out, part)
            covered += width
        if covered == n:
            return mix(out + U(n))
        run = fold(run[:-width], run[width:])
        width *= 2


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-word shingles of one text; a shorter text is one shingle, no words none."""
    if len(hashes) >= n:
        return np.unique(grams(hashes, n))
    if not len(hashes):
        return hashes
    return mix(grams(hashes, len(hashes)) + U(len(hashes)))


def pack(values: np.ndarray) -> bytes:
    """Sorted unsigned integers as compressed byte planes of their differences."""
    if not len(values):
        return b""
    values = values.astype(U)
    steps = np.diff(values, prepend=U(0))
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, U)
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(U).ravel(), dtype=U)


def squeeze(values: np.ndarray) -> bytes:
    """Any fixed-width integers as compressed byte planes."""
    width = values.dtype.itemsize
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes(), 1) if len(values) else b""


def expand(blob: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    if not blob:
        return np.zeros(0, kind)
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def cuts(keys: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Where sorted `bits`-wide keys divide into that many even ranges (buckets + 1)."""
    edges = np.array([(k << bits) // buckets for k in range(buckets)], dtype=U)
    return np.append(np.searchsorted(keys, edges), len(keys))
