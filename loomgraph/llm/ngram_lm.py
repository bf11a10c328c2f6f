"""Language-model scoring with an Elias-Fano n-gram trie.

The model is a trigram model with hierarchical Dirichlet smoothing over add-half
unigrams of the training vocabulary and one unknown word:

    p(w)      = (c(w) + 1/2) / (N + (V + 1) / 2)
    p(w | v)  = (c(v w) + M p(w)) / (c(v) + M)
    p(w | uv) = (c(u v w) + M p(w | v)) / (c(u v) + M)

with counts in training texts; a text's first token follows a start mark, and
has no longer context.  Each adds up to one over the words.  The model grows with
the corpus, so no task ever holds it all.

1. *Blocks.*  Texts are read once, where they lie, and kept as blocks of a
   bounded size: the hashes of a block's distinct words and a code for each
   token.  Everything else reads these.
2. *Counts.*  A block sends each part of the model one message: its distinct
   words and n-grams of that part with their counts in training texts.  A part is
   a range of contexts by a range of successors, so the successors of a
   frequent context lie in many parts.  Only messages with contents are sent, so
   there are never more of them than n-grams.
3. *Tries.*  Each part builds its trie in a memory-mapped file that goes with
   the task: contexts, pointers from contexts to successors, and successors as
   context-relative ids (shifted by the last id of the context before, which
   makes them monotone) are Elias-Fano coded; values are frequencies (a
   probability times N), exactly up to EXACT and quantised in steps of two
   millionths beyond.  A lookup searches its context's range for the successor of
   (last value before the range + 1 + id); lookups are sorted, so each coded
   chunk is opened once.  The answers go back in the order of the questions.
4. *Scores.*  A block forms the smoothed probabilities, whose context counts are
   the frequencies one order below, and adds them up by text.

An n-gram is told apart by some bits of its context's hash and some of a hash of
its last word in that context, as many in all as leave a chance of 2**-13 that
one is taken for another, at any size of the corpus.  Contexts that agree in
their bits share a range of successors, which no probability depends on:
context counts are asked for as n-grams of their own.
"""

from __future__ import annotations

import tempfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm import exchange
from loomgraph.llm.kernel import U, expand, fold, pack, slices, squeeze, texts, tidied, tidy, unpack, words
from loomgraph.storage import settle

#: The weight of the lower order's probability, in tokens.
MASS = 3.0
#: Bytes of text in a block, and tokens whose n-grams make a part.
BLOCK_BYTES, PART_TOKENS = 6_000_000, 1_500_000
#: Counts up to which the tries are exact.
EXACT = 1 << 20
_STEP = 2e-6
_START, _END = U(0x243F6A8885A308D3), U(0x13198A2E03707344)
_CHUNK = 1 << 14


def quantised(count: np.ndarray) -> np.ndarray:
    """Counts as codes of less than 25 bits."""
    high = EXACT + np.round(np.log(np.maximum(count, 1) / EXACT) / _STEP)
    return np.where(count < EXACT, count, high).astype(np.uint32)


def frequencies(codes: np.ndarray) -> np.ndarray:
    """What quantised counts stand for."""
    return np.where(codes < EXACT, codes, EXACT * np.exp((np.maximum(codes, EXACT) - float(EXACT)) * _STEP))


class EliasFano:
    """A monotone sequence: low bytes as they are, high parts as a unary bit vector, in chunks of a fixed number of values."""

    def __init__(self, values: np.ndarray, put):
        n = len(values)
        self.n = n
        span = int(values[-1]) // n if n else 0
        self.low = (span.bit_length() + 7) // 8
        high = (values >> U(8 * self.low)) if self.low < 8 else np.zeros(n, U)
        self.heads = values[::_CHUNK].copy()  # the first value of each chunk
        firsts = high[::_CHUNK]
        bits, starts = [], [0]
        for c, a in enumerate(range(0, n, _CHUNK)):
            part = (high[a : a + _CHUNK] - firsts[c]).astype(np.int64)
            unary = np.zeros(int(part[-1]) + len(part), np.uint8)
            unary[part + np.arange(len(part))] = 1
            bits.append(np.packbits(unary))
            starts.append(starts[-1] + len(bits[-1]))
        self.firsts, self.starts = firsts.copy(), starts
        self.bits = put(np.concatenate(bits) if bits else np.zeros(0, np.uint8))
        self.lows = put(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, : self.low]).reshape(n, self.low) if n else np.zeros((0, self.low), np.uint8))

    def chunk(self, c: int) -> np.ndarray:
        a, b = c * _CHUNK, min(self.n, (c + 1) * _CHUNK)
        ones = np.flatnonzero(np.unpackbits(self.bits[self.starts[c] : self.starts[c + 1]]))[: b - a]
        low = np.zeros((b - a, 8), np.uint8)
        low[:, : self.low] = self.lows[a:b]
        low = low.view(U).ravel()
        if self.low == 8:
            return low
        return ((ones - np.arange(b - a)).astype(U) + self.firsts[c]) << U(8 * self.low) | low

    def at(self, places: np.ndarray) -> np.ndarray:
        """The values at places that never go down."""
        out = np.zeros(len(places), U)
        c = places // _CHUNK
        for k in np.unique(c):
            a, b = np.searchsorted(c, [k, k + 1])
            out[a:b] = self.chunk(int(k))[places[a:b] - k * _CHUNK]
        return out

    def successor(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For values that never go down: the place of the first one not below each, and whether it equals it."""
        place, equal = np.full(len(wanted), self.n, np.int64), np.zeros(len(wanted), bool)
        if not self.n:
            return place, equal
        c = np.maximum(np.searchsorted(self.heads, wanted, "left") - 1, 0)
        for k in np.unique(c):
            a, b = np.searchsorted(c, [k, k + 1])
            values = self.chunk(int(k))
            found = np.searchsorted(values, wanted[a:b], "left")
            place[a:b] = found + k * _CHUNK
            inside = found < len(values)
            equal[a:b][inside] = values[found[inside]] == wanted[a:b][inside]
            if k + 1 < len(self.heads):
                equal[a:b][~inside] = self.heads[k + 1] == wanted[a:b][~inside]
        return place, equal


class Trie:
    """One part's contexts, their successors and counts, from sorted distinct (context, successor) pairs with counts over 0."""

    def __init__(self, context: np.ndarray, successor: np.ndarray, count: np.ndarray):
        self.file = tempfile.TemporaryFile()
        new = np.ones(len(context), bool)
        new[1:] = context[1:] != context[:-1]
        first = np.flatnonzero(new)
        known, ids = np.unique(successor, return_inverse=True)
        ends = np.append(first[1:], len(context)) if len(first) else first
        last = ids[ends - 1].astype(U) + U(1) if len(first) else np.zeros(0, U)
        base = np.cumsum(last) - last
        self.words = EliasFano(known, self._put)
        self.contexts = EliasFano(context[first], self._put)
        self.pointers = EliasFano(np.append(first, len(context)).astype(U), self._put)
        self.successors = EliasFano(ids.astype(U) + base[np.cumsum(new) - 1] if len(first) else np.zeros(0, U), self._put)
        self.counts = self._put(quantised(count))

    def _put(self, array: np.ndarray) -> np.ndarray:
        """The array again, mapped from the part's file."""
        if not array.size:
            return array
        at = self.file.seek(0, 2)
        self.file.write(array.tobytes())
        self.file.flush()
        return np.memmap(self.file, array.dtype, "r", at, array.shape)

    def lookup(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """The codes of pairs sorted by context and successor; 0 for unknown ones."""
        codes = np.zeros(len(context), np.uint32)
        asked, back = np.unique(successor, return_inverse=True)
        id, is_word = self.words.successor(asked)
        node, known = self.contexts.successor(context)
        known &= is_word[back]
        if known.any():
            node, id = node[known], id[back][known]
            begin = self.pointers.at(node).astype(np.int64)
            shift = np.zeros(len(begin), U)
            inner = begin > 0
            shift[inner] = self.successors.at(begin[inner] - 1) + U(1)
            end = self.pointers.at(node + 1).astype(np.int64)
            # an id past its context's last one is sought right behind it, so that lookups never go down
            place, equal = self.successors.successor(np.minimum(shift + id.astype(U), self.successors.at(end - 1) + U(1)))
            equal &= place < end
            found = np.zeros(len(place), np.uint32)
            found[equal] = self.counts[place[equal]]
            codes[known] = found
        return codes

    def close(self) -> None:
        self.file.close()


_BLOCKS = pa.schema([("block", pa.int64()), ("tokens", pa.int64()), ("ids", pa.binary()), ("known", pa.binary()), ("held", pa.binary()), ("sizes", pa.binary()), ("vocabulary", pa.binary()), ("times", pa.binary()), ("codes", pa.binary())])
_BLOCKS_SQL = "block long, tokens long, ids binary, known binary, held binary, sizes binary, vocabulary binary, times binary, codes binary"
_SENT = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("words", pa.binary()), ("times", pa.binary()), ("ngrams", pa.binary()), ("counts", pa.binary())])
_SENT_SQL = "bucket long, block long, words binary, times binary, ngrams binary, counts binary"
_REPLY = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("times", pa.binary()), ("codes", pa.binary()), ("n", pa.int64()), ("v", pa.int64())])
_REPLY_SQL = "block long, bucket long, times binary, codes binary, n long, v long"
_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
_SCORES_SQL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _by_count(times: np.ndarray) -> np.ndarray:
    """The words in the order of their codes."""
    return np.argsort(-times.astype(np.int64), kind="stable")


def _held_out(ids: list) -> np.ndarray:
    return np.array([i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i in ids], bool)


def _coded(batches, size: int):
    """Blocks of (doc_id, text) rows: token codes over the block's own vocabulary."""
    partition, made = TaskContext.get().partitionId(), 0
    ids, tokens, sizes, held = [], [], [], 0

    def block():
        nonlocal made
        vocabulary, codes, times = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
        codes = np.argsort(_by_count(times))[codes]  # small codes for frequent words pack better
        row = {"block": partition << 32 | made, "tokens": len(codes), "ids": squeeze(np.array([i or 0 for i in ids], np.int64)), "known": np.packbits([i is not None for i in ids]).tobytes(), "held": np.packbits(_held_out(ids)).tobytes(), "sizes": squeeze(np.concatenate(sizes).astype(np.int64)), "vocabulary": pack(vocabulary), "times": squeeze(times.astype(np.uint32)), "codes": squeeze(codes.astype(np.uint32))}
        made += 1
        return pa.RecordBatch.from_pylist([row], schema=_BLOCKS)

    for batch in batches:
        own = batch.column("doc_id").to_pylist()
        data, offsets = texts(batch.column("text"))
        for a, b in slices(offsets):
            hashes, bounds = words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], True)
            tokens.append(np.insert(hashes, bounds[1:], _END))
            sizes.append(np.diff(bounds) + 1)
            ids += own[a:b]
            held += int(offsets[b] - offsets[a])
            if held >= size:
                yield block()
                ids, tokens, sizes, held = [], [], [], 0
    if ids:
        yield block()
    tidy()


def _runs(bucket: np.ndarray) -> dict[int, tuple[int, int]]:
    """Where the rows of each bucket lie, of rows in the order of their buckets."""
    own, at = np.unique(bucket, return_index=True)
    ends = np.append(at[1:], len(bucket))
    return {b: (x, y) for b, x, y in zip(own.tolist(), at.tolist(), ends.tolist())}


def widths(tokens: int) -> tuple[int, int]:
    """Bits of an n-gram's context and of its last word.

    Those of the last word suffice among the tokens**0.7 or fewer that may follow one context.
    """
    last = min(48, max(32, 13 + -(-tokens.bit_length() * 7 // 10)))
    return max(16, min(64, exchange.key_bits(tokens) + 2) - last), last


class Block:
    """A block's tokens and its distinct n-grams in the order in which parts are asked for them."""

    def __init__(self, row: dict, parts: tuple[int, int], bits: tuple[int, int]):
        self.sizes = expand(row["sizes"], np.int64)
        n = len(self.sizes)
        self.held = np.unpackbits(np.frombuffer(row["held"], np.uint8))[:n].astype(bool)
        self.vocabulary = unpack(row["vocabulary"])
        self.codes = _by_count(expand(row["times"], np.uint32))[expand(row["codes"], np.uint32)]
        self.first = np.append(0, np.cumsum(self.sizes))[:-1]
        self.train = np.repeat(~self.held, self.sizes)
        self.words = _runs(((self.vocabulary >> U(32)) * U(parts[0] * parts[1])) >> U(32))
        token = self.vocabulary[self.codes]
        one = np.empty(len(token), U)
        one[1:] = token[:-1]
        one[self.first] = _START
        inner = np.ones(len(token), bool)
        inner[self.first] = False
        self.inner = np.flatnonzero(inner)  # tokens that have two before them, the start mark included
        two = fold(one[self.inner - 1], one[self.inner])
        context = np.concatenate([one, two])
        # a word's id is relative to its context, so that contexts that share their bits do not share ids
        successor = fold(context, np.concatenate([token, token[self.inner]])) >> U(64 - bits[1])
        context >>= U(64 - bits[0])
        # what is asked of each part: sorted by part, context and successor
        bucket = (((context >> U(max(bits[0] - 32, 0))) * U(parts[0])) >> U(min(bits[0], 32))) * U(parts[1])
        if parts[1] > 1:
            bucket += ((successor >> U(max(bits[1] - 32, 0))) * U(parts[1])) >> U(min(bits[1], 32))
        bucket, key = bucket.astype(np.int64), context << U(bits[1]) | successor
        order = np.lexsort((key, bucket)) if parts[1] > 1 else np.argsort(key, kind="stable")
        bucket, key = bucket[order], key[order]
        new = np.ones(len(order), bool)
        new[1:] = key[1:] != key[:-1]
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.cumsum(new) - 1
        self.keys = key[new]
        self.count = np.bincount(self.number, np.concatenate([self.train, self.train[self.inner]]), minlength=int(new.sum())).astype(np.uint32)
        self.ngrams = _runs(bucket[new])


def _asking(parts: tuple[int, int], bits: tuple[int, int]):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, parts, bits)
                times = np.bincount(block.codes[block.train], minlength=len(block.vocabulary))
                out = {c: [] for c in _SENT.names}
                for b in sorted(block.ngrams.keys() | block.words.keys()):
                    lo, hi = block.ngrams.get(b, (0, 0))
                    x, y = block.words.get(b, (0, 0))
                    for c, v in zip(out, (b, row["block"], pack(block.vocabulary[x:y]), squeeze(times[x:y].astype(np.uint32)), pack(block.keys[lo:hi]), squeeze(block.count[lo:hi]))):
                        out[c].append(v)
                yield pa.RecordBatch.from_pydict(out, schema=_SENT)
        tidy()

    return run


def _answering(bits: tuple[int, int]):
    @tidied
    def run(table: pa.Table) -> pa.Table:
        column = lambda c: (x.as_py() for x in table[c])
        vocabularies = [unpack(x) for x in column("words")]
        _, back = np.unique(np.concatenate(vocabularies), return_inverse=True)
        total = np.bincount(back, np.concatenate([expand(x, np.uint32) for x in column("times")])).astype(np.int64) if len(back) else np.zeros(0, np.int64)
        each, ends = total[back], np.append(0, np.cumsum([len(v) for v in vocabularies]))
        times = [squeeze(each[a:b]) for a, b in zip(ends, ends[1:])]
        asked = [unpack(x) for x in column("ngrams")]
        cut = np.append(0, np.cumsum([len(x) for x in asked]))
        keys, back = np.unique(np.concatenate(asked), return_inverse=True)
        summed = np.bincount(back, np.concatenate([expand(x, np.uint32) for x in column("counts")]), minlength=len(keys)).astype(np.int64) if len(keys) else np.zeros(0, np.int64)
        context, successor = keys >> U(bits[1]), keys & U((1 << bits[1]) - 1)
        seen = summed > 0
        trie = Trie(context[seen], successor[seen], summed[seen])
        codes = trie.lookup(context, successor)[back]
        trie.close()
        rest = [0] * (table.num_rows - 1)
        return pa.table({"block": table["block"], "bucket": table["bucket"], "times": times, "codes": [squeeze(codes[a:b]) for a, b in zip(cut, cut[1:])], "n": [int(total.sum()), *rest], "v": [int((total > 0).sum()), *rest]}, schema=_REPLY)

    return run


@tidied
def _scored(table: pa.Table, replies: pa.Table, parts: tuple[int, int], bits: tuple[int, int], n: int, v: int, mass: float) -> pa.Table:
    if not table.num_rows:
        return _SCORES.empty_table()
    row = table.to_pylist()[0]
    block = Block(row, parts, bits)
    times, codes = np.zeros(len(block.vocabulary), np.int64), np.zeros(len(block.keys), np.uint32)
    for b, t, c in zip(replies["bucket"].to_pylist(), replies["times"].to_pylist(), replies["codes"].to_pylist()):
        if b in block.words:
            times[slice(*block.words[b])] = expand(t, np.int64)
        if b in block.ngrams:
            codes[slice(*block.ngrams[b])] = expand(c, np.uint32)
    c1 = times[block.codes]
    found = frequencies(codes)[block.number]
    c2, c3 = found[: len(c1)], found[len(c1) :]
    p = (c1 + 0.5) / (n + 0.5 * (v + 1))
    base = np.add.reduceat(np.log10(p), block.first)
    before = np.empty(len(c1))
    before[1:] = c1[:-1]
    before[block.first] = times[np.searchsorted(block.vocabulary, _END)]  # as many starts as ends
    p = (c2 + mass * p) / (before + mass)
    p[block.inner] = (c3 + mass * p[block.inner]) / (c2[block.inner - 1] + mass)
    count = len(block.sizes)
    known = np.unpackbits(np.frombuffer(row["known"], np.uint8))[:count].astype(bool)
    ids = pa.array(expand(row["ids"], np.int64), mask=~known)
    return pa.table({"doc_id": ids, "held_out": block.held, "n_tokens": block.sizes, "n_known": np.add.reduceat((c1 > 0).astype(np.int64), block.first), "train_tokens": np.full(count, n), "base_score": base, "score": np.add.reduceat(np.log10(p), block.first)}).cast(_SCORES)


def score(docs: DataFrame, *, id: str = "doc_id", text: str = "text", mass: float = MASS, block_bytes: int = BLOCK_BYTES, part_tokens: int = PART_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    The model learns from the rows whose crc32(id as text) mod 5 is not 1, null
    ids among them.  Null or blank text is the end token alone.  Repeated rows
    count each.  Other columns are not read.  Without any training row c and N
    are 0, and score is the base model's.  Ids are whole numbers.
    """
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    blocks = settle(rows.mapInArrow(lambda batches: _coded(batches, block_bytes), _BLOCKS_SQL))
    tokens = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    bits = widths(tokens)
    wanted = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), tokens // part_tokens + 1)
    across = int(np.ceil(np.sqrt(wanted)))
    parts = (-(-wanted // across), across)
    sent = blocks.mapInArrow(_asking(parts, bits), _SENT_SQL)
    replies = settle(sent.groupBy("bucket").applyInArrow(_answering(bits), _REPLY_SQL))
    n, v = replies.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(lambda a, b: _scored(a, b, parts, bits, n, v, mass), _SCORES_SQL)


def op5_ngram_score(spark, sf_dir):
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
