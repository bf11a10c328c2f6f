"""Quality classifier by importance resampling.

Two generative models over hashed n-grams are compared: the target's, from
documents labelled good, and the raw one, from all documents.

*Resampling* (`importance`, `draw`).  n-grams are single words and word pairs,
counted as often as they occur.  A document's log importance weight is the sum
over its n-grams of the log ratio of the two models, of either sign.  A sample of
a given size is drawn without replacement by Gumbel top-k: the rows of largest
weight / temperature + Gumbel noise, where the noise is a hash of the row.

*Rejection* (`fit`, `resample`, `keep_good`).  A sum of both signs grows with
the length of a text, and a long toxic document wins by its clean part (README
has figures), so for rejecting documents an n-gram counts once a document,
ratios that the counts do not bear out (within `dead` of 0) and ratios in its
favour count as 0: a document is as good as the target until its n-grams say
otherwise, whatever its length.  The ratios are smoothed for what is expected of
frequent n-grams; a rarer one counts with a light prior if, by the exact test,
the labelled documents that hold it are bad ones by less than chance `rare`.
n-grams here are words (A-Z lower-cased, without marks around them), and pairs
of word *shapes* (capitals, digits, marks, repetition), so noise shows even in
new words.  These weights go through a Gumbel top-k too; k is the number of
documents whose weight reaches the cut that best tells good from bad among the
labelled ones.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.kernel import U, expand, fold, hashed, mix, remembered, slices, spans, squeeze, texts, tidied, tidy
from loomgraph.storage import settle

#: Hashed n-grams are counted in so many cells.
CELLS = 1 << 21
#: Labelled rows to fit on, those of smallest hash of doc_id; sized so that they can be sent to every executor.
LABELLED = 200_000
#: A good document lost counts as this many bad ones kept, where the cut is chosen.
CARE = 3.0
PRIOR, DEAD, TEMPERATURE = 3.0, 1.0, 0.1
#: The prior of n-grams too rare for PRIOR, and the chance below which they count.
LIGHT, RARE = 0.5, 0.001
#: The prior of the two models of the resampling, in occurrences, and the share of all rows that op3 draws by it.
ALPHA, SAMPLE = 1.0, 0.5
_SLOTS, _FAN_IN = 64, 512
_UPPER, _LOWERS, _DIGIT, _MARK = (np.zeros(256, np.uint8) for _ in range(4))
_UPPER[65:91] = 1
_LOWERS[97:123] = 1
_DIGIT[48:58] = 1
_MARK[[b for b in range(33, 127) if not chr(b).isalnum()]] = 1


_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32


def _cores(data: np.ndarray, offsets: np.ndarray):
    """Where words start and end, the hashes of what is left of them without the marks around it, and each word's row."""
    start, end = spans(data, offsets)
    row = np.searchsorted(offsets, start, "right") - 1
    if not len(start):
        return start, end, np.zeros(0, U), row
    place, mark = np.arange(len(data)), _MARK[data] > 0
    first = np.minimum.accumulate(np.where(mark, len(data), place)[::-1])[::-1]
    last = np.maximum.accumulate(np.where(mark, -1, place))
    begin = np.minimum(first[start], end)
    return start, end, hashed(_PLAIN[data], begin, np.maximum(last[end - 1] + 1, begin)), row


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and cell of every distinct word and pair of shapes of every row, sorted."""
    start, end, hashes, row = _cores(data, offsets)
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    count = lambda table: (total := np.append(0, np.cumsum(table[data], dtype=np.int64)))[end] - total[start]
    upper, lower, digit, mark = (count(t) for t in (_UPPER, _LOWERS, _DIGIT, _MARK))
    same = np.zeros(n, np.int64)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    shape = np.minimum(upper, 2) | np.minimum(lower, 1) << 2 | np.minimum(digit, 2) << 3 | np.minimum(mark, 3) << 5 | same << 7
    pair = np.where(np.append(True, row[1:] != row[:-1]), 1 << 16, shape + 1)
    pair[1:] = np.where(row[1:] == row[:-1], (shape[:-1] + 1) << 8 | shape[1:], pair[1:])
    cells = np.concatenate([hashes % U(CELLS), mix(pair.astype(U) + U(0x5BD1E995)) % U(CELLS)]).astype(np.int64)
    both = np.unique(np.concatenate([row, row]) << 21 | cells)
    return both >> 21, both & (CELLS - 1)


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and cell of every word and every pair of neighbouring words, as often as they occur."""
    *_, hashes, row = _cores(data, offsets)
    inner = np.flatnonzero(row[1:] == row[:-1])
    pairs = fold(hashes[inner], hashes[inner + 1])
    return np.concatenate([row, row[inner]]), (np.concatenate([mix(hashes + U(1)), pairs]) % U(CELLS)).astype(np.int64)


#: Bytes of text whose n-grams a worker holds at once.
PIECE_BYTES = 1 << 18


def _pieces(column):
    data, offsets = texts(column)
    for a, b in slices(offsets, PIECE_BYTES):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


#: Counts by cell: of documents for rejection (all, good, bad), of occurrences for resampling (all, in good).
_KINDS = ("raw", "good", "bad", "raw_times", "good_times")
_SUMS = ("n_raw", "n_good", "n_bad")
_COUNTS = pa.schema([("slot", pa.int32()), ("part", pa.int64()), *((c, pa.binary()) for c in _KINDS), *((c, pa.int64()) for c in _SUMS)])
_COUNTS_SQL = "slot int, part long, " + ", ".join([*(f"{c} binary" for c in _KINDS), *(f"{c} long" for c in _SUMS)])


def _counter(times: bool):
    """One partition's counts, cut into slots of cells; occurrences only if asked."""

    def run(batches):
        remembered()
        counts = {c: np.zeros(CELLS, np.int32) for c in _KINDS}
        sums = dict.fromkeys(_SUMS, 0)
        for batch in batches:
            is_good, is_bad = np.asarray(batch.column("good").fill_null(False)), ~np.asarray(batch.column("good").fill_null(True))
            for c, n in zip(_SUMS, (len(is_good), int(is_good.sum()), int(is_bad.sum()))):
                sums[c] += n
            for a, b, data, offsets in _pieces(batch.column("text")):
                row, cell = features(data, offsets)
                np.add.at(counts["raw"], cell, 1)
                np.add.at(counts["good"], cell[is_good[a:b][row]], 1)
                np.add.at(counts["bad"], cell[is_bad[a:b][row]], 1)
                if times:
                    row, cell = ngrams(data, offsets)
                    np.add.at(counts["raw_times"], cell, 1)
                    np.add.at(counts["good_times"], cell[is_good[a:b][row]], 1)
        if sums["n_raw"]:
            own = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict({"slot": list(range(_SLOTS)), "part": [own] * _SLOTS, **{c: [squeeze(x.astype(np.int64)) for x in np.array_split(counts[c], _SLOTS)] for c in _KINDS}, **{c: [n] + [0] * (_SLOTS - 1) for c, n in sums.items()}}, schema=_COUNTS)
        tidy()

    return run


@tidied
def _total(table: pa.Table) -> pa.Table:
    def add(c):
        total = 0
        for blob in table[c]:
            total = total + expand(blob.as_py(), np.int64)
        return squeeze(total)

    return pa.table({"slot": table["slot"][:1], "part": table["part"][:1], **{c: [add(c)] for c in _KINDS}, **{c: [sum(table[c].to_pylist())] for c in _SUMS}}, schema=_COUNTS)


def _totals(rows: DataFrame, times: bool) -> list:
    """The counts of all partitions by slot, added up in two steps, so that no task sees more than a few hundred messages."""
    parts = rows.mapInArrow(_counter(times), _COUNTS_SQL)
    some = parts.groupBy("slot", F.floor(F.col("part") / _FAN_IN).alias("group")).applyInArrow(_total, _COUNTS_SQL)
    return some.groupBy("slot").applyInArrow(_total, _COUNTS_SQL).orderBy("slot").collect()


@dataclass(frozen=True)
class Model:
    """By cell, the ratios that reject and the log ratios of the two models; the cut of the former."""

    ratios: np.ndarray
    cut: float
    logs: np.ndarray


def labelled(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", limit: int = LABELLED) -> DataFrame:
    """text and good (null where unlabelled) of every row.  A document is good if no label calls it bad or toxic."""
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(((F.coalesce(F.min("quality"), F.lit(1)) > 0) & (F.coalesce(F.max("toxic"), F.lit(0)) == 0)).alias("good"))
    marks = marks.orderBy(F.xxhash64("doc_id")).limit(limit).withColumnRenamed("doc_id", "_labelled")
    left = docs.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return left.join(F.broadcast(marks), left["doc_id"] == marks["_labelled"], "left").select("text", "good")


def fit(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", limit: int = LABELLED, prior: float = PRIOR, dead: float = DEAD, alpha: float = ALPHA, times: bool = False) -> Model:
    """Two passes over docs: the models, then the cut.  The driver gets CELLS counts and two short histograms.

    Without good or without bad labelled documents nothing is cut.  The log
    ratios of the resampling are 0 unless `times` asks for the occurrences.
    """
    rows = labelled(docs, labels, id=id, text=text, limit=limit)
    totals = _totals(rows, times)
    n_raw, n_good, n_bad = (sum(r[c] for r in totals) for c in _SUMS)
    if not n_good:
        none = np.zeros(CELLS, np.float32)
        return Model(none, -np.inf, none)
    # slot by slot, so that the driver holds no more than the two results
    counts = lambda r, c: expand(bytes(r[c]), np.int64).astype(float)
    chance = functools.cache(lambda b, g: _chance(int(b), int(g), n_bad, n_good))
    ratios = np.concatenate([_rejecting(counts(r, "raw"), counts(r, "good"), counts(r, "bad"), n_good / n_raw, chance, prior, dead) for r in totals])
    if times:
        share = sum(counts(r, "good_times").sum() for r in totals) / max(1.0, sum(counts(r, "raw_times").sum() for r in totals))
        logs = np.concatenate([log_ratios(counts(r, "raw_times"), counts(r, "good_times"), share, alpha).astype(np.float32) for r in totals])
    else:
        logs = np.zeros(CELLS, np.float32)
    del totals
    tidy()
    bins = _weights(rows.where(F.col("good").isNotNull()), {"weight": (ratios, features)}, "text").groupBy("good", F.floor(F.col("weight") * 4).alias("bin")).count().collect()
    return Model(ratios, _best_cut([(r["bin"] / 4, r["good"], r["count"]) for r in bins]), logs)


def _rejecting(raw: np.ndarray, good: np.ndarray, bad: np.ndarray, share: float, chance, prior: float, dead: float) -> np.ndarray:
    """The ratios that reject, of some cells, from document counts; share is that of good documents."""
    ratios = np.log((good + prior) / (raw * share + prior))
    ratios[ratios > -dead] = 0
    light = np.log((good + LIGHT) / (raw * share + LIGHT))
    seen = np.flatnonzero((ratios == 0) & (light <= -dead) & (bad > 0))
    told = seen[np.array([chance(b, g) < RARE for b, g in zip(bad[seen], good[seen])], bool)]
    ratios[told] = light[told]
    return ratios.astype(np.float32)


def log_ratios(raw: np.ndarray, target: np.ndarray, share: float, alpha: float = ALPHA) -> np.ndarray:
    """log(p_target / p_raw) by cell from counts of occurrences, where alpha occurrences are added to both, in proportion.

    share is that of the target's occurrences in all.
    """
    return np.log((target + alpha) / (raw * share + alpha))


def _chance(b: int, g: int, n_bad: int, n_good: int) -> float:
    """Of b + g documents drawn from n_bad and n_good, the chance that b or more are bad (Fisher's exact test)."""
    ways = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    drawn = b + g
    return sum(math.exp(ways(n_bad, k) + ways(n_good, drawn - k) - ways(n_bad + n_good, drawn)) for k in range(b, min(drawn, n_bad) + 1) if drawn - k <= n_good)


def _best_cut(bins: list[tuple[float, bool, int]]) -> float:
    """The lowest weight kept: of all, that with the least CARE * share of good below + share of bad above."""
    n_good, n_bad = sum(n for _, g, n in bins if g), sum(n for _, g, n in bins if not g)
    if not n_good or not n_bad:
        return -np.inf
    loss = lambda cut: CARE * sum(n for w, g, n in bins if g and w < cut) / n_good + sum(n for w, g, n in bins if not g and w >= cut) / n_bad
    return min(sorted({w for w, _, _ in bins}), key=lambda c: (loss(c), c))


def _weights(df: DataFrame, by: dict, text: str) -> DataFrame:
    """df with a column for each of by, {name: (value of every cell, function to rows and cells)}: the sum over a row's cells."""
    cells = {c: np.flatnonzero(values) for c, (values, _) in by.items()}
    sent = df.sparkSession.sparkContext.broadcast({c: (at.astype(np.int32), by[c][0][at].astype(np.float32)) for c, at in cells.items()})  # CELLS each at most
    kinds = {c: f for c, (_, f) in by.items()}

    def run(batches):
        remembered()
        own = {}
        for c, (cell_of, value) in sent.value.items():
            own[c] = np.zeros(CELLS, np.float32)
            own[c][cell_of] = value
        for batch in batches:
            out = {c: np.zeros(batch.num_rows) for c in kinds}
            for a, b, data, offsets in _pieces(batch.column(text)):
                for c, f in kinds.items():
                    row, cell = f(data, offsets)
                    out[c][a:b] = np.bincount(row, own[c][cell], minlength=b - a)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x) for x in out.values())], names=[*batch.schema.names, *out])
        tidy()

    return df.mapInArrow(run, ", ".join([*(f"`{c}` {t}" for c, t in df.dtypes), *(f"{c} double" for c in by)]))


def gumbel(id: str, text: str, seed: int = 11):
    """Standard Gumbel noise, a hash of the row."""
    uniform = (F.pmod(F.xxhash64(F.lit(seed), F.col(f"`{id}`"), F.col(f"`{text}`")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def scored(docs: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text", temperature: float = TEMPERATURE) -> DataFrame:
    """docs with `_weight` and `_key`, the key of the Gumbel top-k that rejects; rows equal in id and text have equal keys."""
    weighed = _weights(docs, {"_weight": (model.ratios, features)}, text)
    return weighed.withColumn("_key", F.col("_weight") / temperature + gumbel(id, text))


def importance(docs: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text", temperature: float = 1.0) -> DataFrame:
    """docs with `_importance`, the log importance weight, and `_draw`, the key of the resampling."""
    weighed = _weights(docs, {"_importance": (model.logs, ngrams)}, text)
    return weighed.withColumn("_draw", F.col("_importance") / temperature + gumbel(id, text, 23))


def draw(docs: DataFrame, labels: DataFrame, size: int, *, id: str = "doc_id", text: str = "text", temperature: float = 1.0) -> DataFrame:
    """The `size` rows of docs that importance resampling draws, with the columns of docs.

    Rows of equal id and text are drawn together, so there can be more; all
    rows where there are no more than size, or no good labelled one.
    """
    model = fit(docs, labels, id=id, text=text, times=True)
    rows = docs.select(F.struct("*").alias("_row"), F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    keyed = settle(importance(rows, model, id="id", temperature=temperature).select("_row", "_draw"))
    return keyed.where(F.col("_draw") >= kth_largest(keyed, "_draw", size)).select("_row.*")


def kth_largest(df: DataFrame, column: str, k: int, exact: int = 20_000) -> float:
    """The k-th largest value: bins are counted and the one that holds it divided again, until few rows are left to look at."""
    if k <= 0:
        return float("inf")
    lo, hi = df.agg(F.min(column), F.max(column)).first()
    if lo is None:
        return float("-inf")
    left = k
    inside = df.select(column)
    while True:
        n = inside.count()
        if n <= exact or lo == hi:
            values = sorted((r[0] for r in inside.limit(exact).collect()), reverse=True)
            return values[min(left, len(values)) - 1] if lo != hi else lo
        step = (hi - lo) / 256
        bin_of = F.least(F.floor((F.col(column) - lo) / step), F.lit(255)).cast("int")
        bins = inside.groupBy(bin_of.alias("b")).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).orderBy(F.desc("b")).collect()
        for r in bins:
            if left <= r["n"]:
                break
            left -= r["n"]
        lo, hi = r["lo"], r["hi"]
        inside = inside.where(F.col(column).between(lo, hi))


def resample(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", keep: int | None = None, temperature: float = TEMPERATURE) -> tuple[Model, DataFrame, float]:
    """The model, (id, weight, key) of every row, and the least key of the `keep` rows drawn.

    keep defaults to the number of rows whose weight reaches the model's cut.
    Null and empty texts have no n-grams and weight 0.  Rows equal in id and
    text are drawn together.  Labels may repeat or name unknown documents.
    """
    model = fit(docs, labels, id=id, text=text)
    keys = settle(scored(docs, model, id=id, text=text, temperature=temperature).select(F.col(f"`{id}`").alias("doc_id"), F.col("_weight").alias("weight"), F.col("_key").alias("key")))
    if keep is None:
        keep = keys.where(F.col("weight") >= model.cut).count()
    return model, keys, kth_largest(keys, "key", keep)


def keep_good(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of docs that are drawn, with the columns of docs."""
    model, _, least = resample(docs, labels, id=id, text=text, **options)
    temperature = options.get("temperature", TEMPERATURE)
    rows = docs.select(F.struct("*").alias("_row"), F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return scored(rows, model, id="id", text="text", temperature=temperature).where(F.col("_key") >= least).select("_row.*")


def op3_quality_resample(spark, sf_dir):
    """doc_id; weight, key and kept of the rejection; importance, draw_key and draws (1 or 0) of a resample of SAMPLE of all rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), times=True)
    both = _weights(docs, {"weight": (model.ratios, features), "importance": (model.logs, ngrams)}, "text")
    keys = settle(both.select("doc_id", "weight", (F.col("weight") / TEMPERATURE + gumbel("doc_id", "text")).alias("key"), "importance", (F.col("importance") + gumbel("doc_id", "text", 23)).alias("draw_key")))
    sizes = keys.agg(F.count_if(F.col("weight") >= model.cut).alias("good"), F.count("*").alias("all")).first()
    least, drawn = kth_largest(keys, "key", sizes["good"]), kth_largest(keys, "draw_key", round(SAMPLE * sizes["all"]))
    return keys.withColumn("kept", F.col("key") >= least).withColumn("draws", (F.col("draw_key") >= drawn).cast("long"))
