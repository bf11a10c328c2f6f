"""Approximate nearest neighbours with a hash-prefix forest.

*Routing.*  The leading bits of one long hash string (signs of random
projections) name a vector's cell, so that a cell holds about `block` vectors; a
cell with many more is cut into blocks by id.  A query visits the cells whose
prefixes it is nearest to: its own and those that differ in bits where its
projection is small, in the order of the squares of these.  How many cells that
is, is fitted on at most SAMPLE vectors, so that RECALL of a sampled query's
neighbours are in them: few where the vectors lie in clusters, many where they
lie evenly.

*Forest.*  Each block builds a forest: per tree a long hash string of every
distinct vector, in one sorted array.  A query descends each tree to the vectors
that share its longest prefix, a range of the array; then all trees ascend
together, one bit at a time, which widens the ranges, until their ranges hold
enough entries.  How many that is, each block fits on some of its queries,
whose neighbours in the block it computes.  The distinct candidates are ranked
by exact inner products of the original vectors in double precision, and the
best of all blocks win.

Equal vectors are one entry of a forest, which keeps only as many of their
smallest ids as can be in a result, so ties are exact and a vector however
frequent makes no long list.  A query that finds fewer than k others is asked
again of all cells.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.llm.kernel import tidied
from loomgraph.storage import settle

BLOCK = 8192
TREES = 24
BITS = 32
#: The share of neighbours that routing, and each block's candidates, are fitted to hold; and the vectors fitted on.
RECALL, SAMPLE, TRIED = 0.96, 4096, 64
#: Entries over all trees at which ascending may stop, as shares of the block's distinct vectors.
LADDER = (0.03, 0.1, 0.2, 0.35, 0.5, 0.7, 1.0, 1.5, 2.2, 3.0)


def planes(dims: int, count: int, seed: int) -> np.ndarray:
    """Normal vectors of random hyperplanes; the last coordinate is the one that makes all base vectors equally long."""
    return np.random.default_rng([seed, dims]).standard_normal((dims + 1, count))


def longer(matrix: np.ndarray, square: float) -> np.ndarray:
    """Base vectors with one more coordinate, so that the largest inner product with a query is the smallest angle."""
    return np.hstack([matrix, np.sqrt(np.maximum(square - (matrix**2).sum(1), 0))[:, None]])


class Forest:
    """Sorted arrays of hash strings over the rows of a matrix."""

    def __init__(self, matrix: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 5):
        self.n, self.bits, self.trees = len(matrix), bits, trees
        self.planes = planes(matrix.shape[1], trees * bits, seed).astype(np.float32)
        full = longer(matrix, (matrix**2).sum(1).max()) if len(matrix) else np.zeros((0, matrix.shape[1] + 1))
        strings = self._strings(full)
        self.rows = np.argsort(strings, axis=1, kind="stable")
        self.keys = np.take_along_axis(strings, self.rows, 1)

    def _strings(self, matrix: np.ndarray) -> np.ndarray:
        """Hash strings of shape (trees, rows)."""
        side = (matrix.astype(np.float32) @ self.planes[: matrix.shape[1]] > 0).reshape(len(matrix), self.trees, self.bits)
        weight = np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64)
        return np.stack([side[:, t] @ weight for t in range(self.trees)])

    def ranges(self, queries: np.ndarray, wanted: float):
        """(lo, hi) of shape (trees, queries): every tree's range at the longest prefix where they hold `wanted` in all."""
        keys = self._strings(queries)
        lo, hi = np.zeros(keys.shape, np.int64), np.full(keys.shape, self.n, np.int64)
        undecided = np.arange(keys.shape[1])
        # strings of so many bits are nearly all different, so most queries need no deeper level
        for depth in range(min(self.bits, self.n.bit_length() + 2), 0, -1):
            if not len(undecided):
                break
            free = np.uint64(self.bits - depth)
            first = (keys[:, undecided] >> free) << free
            last = first | ((np.uint64(1) << free) - np.uint64(1))
            a = np.stack([np.searchsorted(k, f, "left") for k, f in zip(self.keys, first)])
            b = np.stack([np.searchsorted(k, f, "right") for k, f in zip(self.keys, last)])
            done = (b - a).sum(0) >= wanted
            lo[:, undecided[done]], hi[:, undecided[done]] = a[:, done], b[:, done]
            undecided = undecided[~done]
        return lo, hi

    def candidates(self, queries: np.ndarray, wanted: float) -> np.ndarray:
        """Whether a row is in a query's ranges, of shape (queries, rows)."""
        lo, hi = self.ranges(queries, wanted)
        mark = np.zeros((len(queries), self.n), bool)
        for t in range(self.trees):
            for q in range(len(queries)):
                mark[q, self.rows[t, lo[t, q] : hi[t, q]]] = True
        return mark


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten().cast(pa.float64())).reshape(len(column), -1)


def _fitted(forest: Forest, distinct: np.ndarray, wanted: np.ndarray, near: int) -> float:
    """The least step of the ladder at which the candidates of some queries hold RECALL of their `near` nearest rows."""
    tried = wanted[np.linspace(0, len(wanted) - 1, min(TRIED, len(wanted))).astype(int)]
    scores = tried @ distinct.T
    best = np.argpartition(-scores, min(near, len(distinct) - 1), axis=1)[:, : near + 1]  # one may be the query itself
    for share in LADDER:
        if np.take_along_axis(forest.candidates(tried, share * len(distinct)), best, 1).mean() >= RECALL:
            return share
    return np.inf


@tidied
def _search(base: pa.Table, queries: pa.Table, k: int, trees: int, bits: int, near: int) -> pa.Table:
    if not base.num_rows or not queries.num_rows:
        return _FOUND.empty_table()
    ids, vectors = np.asarray(base["vec_id"].combine_chunks()), _matrix(base["vector"])
    _, entry = np.unique(vectors.view(f"V{vectors.shape[1] * 8}").ravel(), return_inverse=True)
    order = np.lexsort((ids, entry))
    ids, vectors, entry = ids[order], vectors[order], entry[order]
    fresh = np.ones(len(ids), bool)  # a repeated row counts once
    fresh[1:] = (ids[1:] != ids[:-1]) | (entry[1:] != entry[:-1])
    ids, vectors, entry = ids[fresh], vectors[fresh], entry[fresh]
    start = np.searchsorted(entry, np.arange(entry[-1] + 2))
    distinct, held = vectors[start[:-1]], np.minimum(np.diff(start), k + 1)
    forest = Forest(distinct, trees, bits)
    asked, wanted = np.asarray(queries["vec_id"].combine_chunks()), _matrix(queries["vector"])
    enough = max(_fitted(forest, distinct, wanted, near) * len(distinct), k + 1)
    out_q, out_v, out_s = [], [], []
    for at in range(0, len(asked), 256):
        some = wanted[at : at + 256]
        mark = forest.candidates(some, enough) if enough < trees * len(distinct) else np.ones((len(some), len(distinct)), bool)
        mark[mark @ held <= k] = True  # too few others: all rows of the block
        rough = np.where(mark, some @ distinct.T, -np.inf)
        for q, count in enumerate(mark.sum(1)):
            take = 2 * k + 2
            while True:
                rows = np.argpartition(-rough[q], take - 1)[:take] if take < count else np.flatnonzero(mark[q])
                # one sum for each row, in one order, so that equal vectors have equal scores in every block
                scores = (distinct[rows] * some[q]).cumsum(1)[:, -1]
                own = [ids[start[r] : start[r] + held[r]] for r in rows]
                v, s = np.concatenate(own), np.repeat(scores, held[rows])
                best = np.lexsort((v, -s))
                v, s = v[best], s[best]
                first = np.sort(np.unique(v, return_index=True)[1])  # the best row of each id
                first = first[v[first] != asked[at + q]][:k]
                if len(first) == k or take >= count:
                    break
                take *= 4
            out_q.append(np.full(len(first), asked[at + q]))
            out_v.append(v[first])
            out_s.append(s[first])
    return pa.table({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_s)}, schema=_FOUND)


def cells(matrix: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The cells of vectors, and the projections that their bits are signs of."""
    side = matrix @ planes_of_cells(matrix.shape[1], bits)
    return (side > 0) @ (1 << np.arange(bits, dtype=np.int64)), side


def planes_of_cells(width: int, bits: int) -> np.ndarray:
    return planes(width - 1, bits, 17)


def probes(queries: np.ndarray, bits: int, count: int) -> np.ndarray:
    """The `count` cells that each query is nearest to, nearest first, of shape (queries, count)."""
    own, side = cells(np.hstack([queries, np.zeros((len(queries), 1))]), bits)
    cost, cell = np.zeros((len(queries), 1)), own[:, None]
    for bit in range(bits):
        cost = np.hstack([cost, cost + side[:, bit : bit + 1] ** 2])
        cell = np.hstack([cell, cell ^ (1 << bit)])
        if cost.shape[1] > count:
            keep = np.argsort(cost, axis=1, kind="stable")[:, :count]
            cost, cell = np.take_along_axis(cost, keep, 1), np.take_along_axis(cell, keep, 1)
    return np.take_along_axis(cell, np.argsort(cost, axis=1, kind="stable"), 1)


def fitted_probes(sample: np.ndarray, total: int, bits: int, square: float, k: int) -> int:
    """How many cells to visit so that RECALL of the sampled vectors' neighbours are in them."""
    whole = 1 << bits
    if len(sample) < 2:
        return whole
    near = min(len(sample) - 1, max(1, round(k * len(sample) / total)))
    asked = sample[:: max(1, len(sample) // 512)]
    scores = asked @ sample.T
    scores[np.arange(len(asked)), np.arange(0, len(sample), max(1, len(sample) // 512))] = -np.inf
    best = np.argpartition(-scores, near - 1, axis=1)[:, :near]
    home, _ = cells(longer(sample, square), bits)
    visited = probes(asked, bits, min(whole, 4096))
    place = np.array([[np.append(np.flatnonzero(v == c), whole)[0] for c in home[b]] for v, b in zip(visited, best)])
    return int(min(whole, np.quantile(place, RECALL, method="higher") + 1))


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part: no null, zero or non-finite ones, no null id."""
    v = F.col("vector")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(f"`{id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    return rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0))


def _by_length(batches, f):
    """Applies f to the vectors of one length of every batch; gives the batch's rows back with what f gave."""
    for batch in batches:
        lengths = np.asarray(batch.column("dims"))
        for n in np.unique(lengths):
            part = batch.filter(pa.array(lengths == n))
            yield part, f(_matrix(part.column("vector")))


def _homes(bits: int, square: float):
    def run(batches):
        for part, cell in _by_length(batches, lambda m: cells(longer(m, square), bits)[0]):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell, pa.int64())], names=[*part.schema.names, "cell"])

    return run


def _routes(bits: int, count: int):
    def run(batches):
        for part, cell in _by_length(batches, lambda m: probes(m, bits, count)):
            wide = part.take(pa.array(np.repeat(np.arange(part.num_rows), cell.shape[1])))
            yield pa.RecordBatch.from_arrays([*wide.columns, pa.array(cell.ravel(), pa.int64())], names=[*wide.schema.names, "cell"])

    return run


_ROW = "dims int, vec_id long, vector array<double>, cell long"


def nearest(vectors: DataFrame, queries: DataFrame, *, k: int = 20, id: str = "vec_id", vector: str = "embedding", block: int = BLOCK, trees: int = TREES, bits: int = BITS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k nearest by inner product, ties to the smaller id.

    A query finds no row of its own id, and only vectors of its length.  Rows
    with a null id, or a vector that is null, zero or holds null or non-finite
    components, take no part.  An id is in a result once, at its best vector,
    however often it repeats; of a repeated query id the least vector asks.
    """
    size = F.size("vector").alias("dims")
    base = usable(vectors, id, vector).select(size, "vec_id", "vector")
    asked = usable(queries, id, vector).groupBy("vec_id").agg(F.min("vector").alias("vector")).select(size, "vec_id", "vector")
    square = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * x)
    total, widest = base.agg(F.count("*"), F.max(square)).first()
    depth = (max(1, -(-total // block)) - 1).bit_length()
    visits, square = 1 << depth, widest or 0.0
    if depth:
        sample = base.orderBy(F.xxhash64("vec_id", F.lit(7)), "vec_id").limit(SAMPLE).collect()
        length = max((len(r["vector"]) for r in sample), key=[len(r["vector"]) for r in sample].count)
        visits = fitted_probes(np.array([r["vector"] for r in sample if len(r["vector"]) == length]), total, depth, square, k)
    base = base.mapInArrow(_homes(depth, square), _ROW)
    # blocks of a cell: its rows are dealt by id, and a query of the cell meets them all
    many = base.groupBy("cell").agg(F.ceil(F.count("*") / (2 * block)).cast("int").alias("blocks"))
    rows = base.join(many, "cell").select("cell", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.col("blocks")).cast("int").alias("part"), "dims", "vec_id", "vector")
    near = max(2, -(-2 * k // visits))
    by = ["cell", "part", "dims"]

    def ask(some: DataFrame, count: int) -> DataFrame:
        routed = some.mapInArrow(_routes(depth, count), _ROW).join(many, "cell")
        routed = routed.select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), "dims", "vec_id", "vector")
        found = rows.groupBy(*by).cogroup(routed.groupBy(*by)).applyInArrow(lambda a, b: _search(a, b, k, trees, bits, near), "query_id long, vec_id long, score double")
        best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    found = ask(asked, visits)
    if visits == 1 << depth:
        return found
    found = settle(found)
    full = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = settle(asked.join(full, "vec_id", "left_anti").select("dims", "vec_id", "vector"))
    if short.isEmpty():
        return found
    return found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(ask(short, 1 << depth))


def op8_hash_prefix_forest(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))
