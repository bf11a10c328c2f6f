"""Byte-level BPE by speculation and verification.

A text is cut into words by the usual byte-level pattern.  For the words of a
batch that were not met before, greedy longest match proposes tokens.  A
proposal is the true encoding exactly if each pair of neighbouring tokens is
the encoding of the pair's bytes; all pairs of the batch are tested at once
with arrays (`Merges.compatible`).  Only words with a failing pair go through
the exact merge loop.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from loomgraph.llm.kernel import remembered, slices, texts, tidy

PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
VOCABULARY = "byte_bpe_50k.json"
#: Words that a worker remembers and their characters, in two generations: when the younger one has half of
#: either, it becomes the older one, and words met again move to the new younger one.
REMEMBERED, REMEMBERED_CHARACTERS = 1_000_000, 40_000_000
#: Pairs of tokens whose test a worker remembers.
TESTED = 250_000


def _byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Merges:
    """A vocabulary, its merges, and what has been learnt about words so far."""

    def __init__(self, blob: bytes):
        spec = json.loads(blob)
        byte = _byte_characters()
        raw = lambda token: bytes(byte[c] for c in token)
        self.id = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes = {i: t for t, i in self.id.items()} | {i: t.encode() for t, i in self.special.items()}
        self.written = {str(i): t for i, t in self.bytes.items()}
        self.decimal = {i: str(i) for i in self.bytes}
        size = max(self.bytes) + 1
        self.left, self.right, self.rank = np.full(size, -1), np.full(size, -1), np.full(size, -1)
        # of a pair: its merge's rank, and in the low 20 bits the id that it becomes
        self.merge: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = (raw(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            x, y, z = self.id[a], self.id[b], self.id[a + b]
            self.merge.setdefault(x * size + y, rank << 20 | z)
            if self.rank[z] < 0:
                self.left[z], self.right[z], self.rank[z] = x, y, rank
        self.never = 1 << 62
        codes = np.fromiter(self.merge, np.int64, len(self.merge))
        order = np.argsort(codes)
        self.size, self.codes, self.ranks = size, codes[order], (np.fromiter(self.merge.values(), np.int64, len(codes)) >> 20)[order]
        self.single = [self.id.get(bytes([k]), -1) for k in range(256)]
        # greedy match may only propose tokens that encode to themselves
        self.proposable = {t: i for t, i in self.id.items() if len(t) == 1 or self.exact(t) == [i]}
        self.begun = {t[:k] for t in self.proposable for k in range(2, len(t) + 1)}
        self.words: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.characters = 0
        self.tested: dict[int, bool] = {}
        self.merged = 0
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def exact(self, word: bytes) -> list[int]:
        """Merge the neighbouring pair of least rank, leftmost first, until none is left."""
        if len(word) > 400:
            return self._exact_long(word)
        merge, size, never = self.merge.get, self.size, self.never
        ids = [*map(self.single.__getitem__, word)]
        order = [merge(a * size + b, never) for a, b in zip(ids, ids[1:])]
        while order and (best := min(order)) != never:
            k = order.index(best)
            ids[k] = own = best & 0xFFFFF
            del ids[k + 1], order[k]
            if k < len(order):
                order[k] = merge(own * size + ids[k + 1], never)
            if k:
                order[k - 1] = merge(ids[k - 1] * size + own, never)
        return ids

    def _exact_long(self, word: bytes) -> list[int]:
        """The same with a heap of (rank, place) over a linked list."""
        merge, size = self.merge.get, self.size
        ids = [self.single[b] for b in word]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(r, k) for k in range(len(ids) - 1) if (r := merge(ids[k] * size + ids[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            nxt = after[k]
            if ids[k] < 0 or nxt == len(ids) or merge(ids[k] * size + ids[nxt]) != r:
                continue
            ids[k], ids[nxt], after[k] = r & 0xFFFFF, -1, after[nxt]
            if after[k] < len(ids):
                before[after[k]] = k
                if (r := merge(ids[k] * size + ids[after[k]])) is not None:
                    heapq.heappush(heap, (r, k))
            if before[k] >= 0 and (r := merge(ids[before[k]] * size + ids[k])) is not None:
                heapq.heappush(heap, (r, before[k]))
        return [i for i in ids if i >= 0]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match: extend while some token begins so, and take the last whole one."""
        ids, at, n, get, begun = [], 0, len(word), self.proposable.get, self.begun
        while at < n:
            to = best = at + 1
            found = self.single[word[at]]
            while to < n:
                to += 1
                piece = word[at:to]
                if piece not in begun:
                    break
                if (token := get(piece)) is not None:
                    found, best = token, to
            ids.append(found)
            at = best
        return ids

    def compatible(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the encoding of the bytes of x[k] y[k] is x[k], y[k].

        It is not exactly if some merge across the border of x and y would have
        come before the merges that built x's right edge and y's left edge.
        Both edges are undone, the later merge first, back to single bytes; at
        each step the two symbols that then met at the border must have no
        merge earlier than the next one that in truth happened beside them
        (on a tie of ranks, the one further left goes first).
        """
        x, y = x.copy(), y.copy()
        good = np.ones(len(x), bool)
        # ranks of the merges that ended the symbols now at the border; none yet
        next_x, next_y = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), np.iinfo(np.int64).max)
        live = np.arange(len(x))
        while len(live):
            code = x[live] * self.size + y[live]
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            rank = np.where(self.codes[at] == code, self.ranks[at], np.iinfo(np.int64).max)
            # it would come before the merge that consumes x's symbol from the left (which wins ties),
            # and before or with the one that consumes y's symbol to the right
            bad = (rank < next_x[live]) & (rank <= next_y[live]) & (rank < np.iinfo(np.int64).max)
            good[live[bad]] = False
            live = live[~bad]
            rx, ry = self.rank[x[live]], self.rank[y[live]]
            more = (rx >= 0) | (ry >= 0)
            live, rx, ry = live[more], rx[more], ry[more]
            undo_x = rx >= ry
            a, b = live[undo_x], live[~undo_x]
            next_x[a], x[a] = rx[undo_x], self.right[x[a]]
            next_y[b], y[b] = ry[~undo_x], self.left[y[b]]
        return good

    def learn(self, words: set[str]) -> None:
        if len(self.tested) > TESTED:
            self.tested.clear()
        size, propose, written = self.size, self.propose, self.decimal.__getitem__
        guess, new = [], set()
        for w in words:
            raw = w.encode()
            ids = propose(raw)
            codes = [x * size + y for x, y in zip(ids, ids[1:])]
            guess.append((w, raw, ids, codes))
            new.update(codes)
        new -= self.tested.keys()
        if new:
            codes = np.fromiter(new, np.int64, len(new))
            self.tested.update(zip(codes.tolist(), self.compatible(codes // size, codes % size).tolist()))
        good = self.tested.__getitem__
        for w, raw, ids, codes in guess:
            if not all(map(good, codes)):
                ids = self.exact(raw)
                self.merged += 1
            self.words[w] = ",".join(map(written, ids))

    def forget(self) -> None:
        """Keep the vocabulary alone."""
        self.words, self.older, self.characters, self.tested = {}, {}, 0, {}

    def encode(self, batch: list[str]) -> list[str]:
        """The comma-joined ids of each text."""
        pieces = [[(p, p in self.special) for p in self.splitter.split(t) if p] if self.splitter and any(s in t for s in self.special) else [(t, False)] for t in batch]
        cut = [[([p], True) if special else (PATTERN.findall(p), False) for p, special in text] for text in pieces]
        needed = {w for text in cut for found, special in text if not special for w in found}
        unknown = needed - self.words.keys()
        if unknown:
            more = sum(map(len, unknown))
            if len(self.words) + len(unknown) > REMEMBERED // 2 or self.characters + more > REMEMBERED_CHARACTERS // 2:
                self.older, self.words, unknown, self.characters = self.words, {}, needed, 0
                more = sum(map(len, needed))
            self.characters += more
            again = unknown & self.older.keys()
            self.words.update((w, self.older[w]) for w in again)
            self.learn(unknown - again)
        return [",".join(str(self.special[w[0]]) if special else ",".join(map(self.words.__getitem__, w)) for w, special in text if w) for text in cut]

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")

    def decode_joined(self, ids: str) -> str:
        """The text of comma-joined ids."""
        return b"".join(map(self.written.__getitem__, ids.split(","))).decode("utf-8", "replace") if ids else ""


def load(blob: bytes) -> Merges:
    """The vocabulary and what was learnt with it, for as long as the worker has no other operator's tasks."""
    loaded, key = remembered("bpe"), hashlib.sha256(blob).hexdigest()
    if key not in loaded:
        loaded[key] = Merges(blob)
    return loaded[key]


def _small(batch: pa.RecordBatch, column: str):
    """Pieces of a batch of about a megabyte of text, with their texts."""
    _, offsets = texts(batch.column(column))
    for a, b in slices(offsets, 1 << 20):
        piece = batch.slice(a, b - a)
        yield piece, [t or "" for t in piece.column(column).to_pylist()]


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where a public tokenizer's file lies on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, *, text: str = "text", vocabulary: str | None = None, ids: bool = True, digests: bool = False, remember: bool = False) -> DataFrame:
    """All columns of docs, with n_tokens (long) and, as asked for, ids (array of int) or ids_sha256 and decoded_sha256.

    The vocabulary, the path of a file of fixed size (byte_bpe_50k.json where none
    is given), is read by the driver and sent to the executors.  Special tokens written out in a text become their ids.  Null
    text is empty: no ids.  New columns replace old ones of the same name.
    With `remember` a worker keeps words from task to task, in some 200 MB that
    it also holds while idle; for a job that does little else.
    """
    with open(vocabulary or vocabulary_path(), "rb") as f:
        blob = docs.sparkSession.sparkContext.broadcast(f.read())
    new = {"n_tokens": pa.int64(), **({"ids": pa.list_(pa.int32())} if ids else {}), **({"ids_sha256": pa.string(), "decoded_sha256": pa.string()} if digests else {})}
    sql = {"n_tokens": "long", "ids": "array<int>", "ids_sha256": "string", "decoded_sha256": "string"}
    keep = [c for c in docs.columns if c not in new or c == text]

    def run(batches):
        merges = load(blob.value)
        for batch in batches:
            for piece, batch_texts in _small(batch, text):
                found = merges.encode(batch_texts)
                out = {"n_tokens": [x.count(",") + 1 if x else 0 for x in found]}
                if ids:
                    out["ids"] = [list(map(int, x.split(","))) if x else [] for x in found]
                if digests:
                    out["ids_sha256"] = [hashlib.sha256(x.encode()).hexdigest() for x in found]
                    out["decoded_sha256"] = [hashlib.sha256(merges.decode_joined(x).encode()).hexdigest() for x in found]
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in keep), *(pa.array(out[c], t) for c, t in new.items())], names=[*keep, *new])
        if not remember:
            merges.forget()
        tidy()

    schema = ", ".join([*(f"`{c}` {t}" for c, t in docs.select(*[f"`{c}`" for c in keep]).dtypes), *(f"{c} {sql[c]}" for c in new)])
    return docs.select(*[f"`{c}`" for c in keep]).mapInArrow(run, schema)


def op7_bpe_roundtrip(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, ids=False, digests=True, remember=True).drop("text")
