"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are partitioned by size (powers of two of their shingle count).  An
item's MinHash sketch is its k smallest shingle hashes, where k is one more
than the shingles that may be missing at the wanted containment: a document
that holds enough of the item must hold one of those k, so the sketch loses no
pair.

1. *Search.*  Documents' shingles are looked up in the sketches, of the
   partitions that the document is long enough for.  Each hit makes the pair of
   document and item a candidate.
2. *Verification.*  Only candidate documents are shingled again, and an item's
   shingles that they hold are counted, for candidate pairs alone.

DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions.arrays import let
from loomgraph.llm.exchange import row_key
from loomgraph.storage import settle

WORDS = 5
THRESHOLD = 0.75
#: Rows up to which item shingles, candidates and repeated ids are broadcast (some 16 bytes each, and overhead); beyond it, joins are shuffled.
BROADCAST_SHINGLES = 500_000


def word_list(text):
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")


def shingle_hashes(words, n: int = WORDS):
    """64-bit hashes of the n-word shingles of an array of words, not distinct; fewer words are one shingle, none none."""
    one = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)])
    return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0))), one))


def item_shingles(items: DataFrame, id: str, text: str, n: int, threshold: float) -> DataFrame:
    """item_id, h, item_shingles, need (shingles that make a leak) and place (by hash) of the distinct shingles of each item."""
    own = items.select(F.col(f"`{id}`").alias("item_id"), word_list(F.col(f"`{text}`")).alias("words"))
    own = own.select("item_id", F.explode(shingle_hashes(F.col("words"), n)).alias("h")).distinct()
    by_item = Window.partitionBy("item_id")
    own = own.select("item_id", "h", F.count("*").over(by_item).alias("item_shingles"), F.row_number().over(by_item.orderBy("h")).alias("place"))
    return own.withColumn("need", F.ceil(F.col("item_shingles") * threshold))


def sketches(own: DataFrame, threshold: float) -> DataFrame:
    """h, item_id and least (words that a document of the item's partition must have) of the k smallest shingles of each item."""
    partition = F.floor(F.log2("item_shingles"))
    return own.where(F.col("place") <= F.col("item_shingles") - F.col("need") + 1).select("h", "item_id", F.ceil(F.pow(F.lit(2), partition) * threshold).alias("least"))


def _small(df: DataFrame) -> DataFrame:
    """df, to be broadcast if it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_SHINGLES else df


def search(docs: DataFrame, sketch: DataFrame, n: int = WORDS) -> DataFrame:
    """The distinct candidate pairs (doc_id, item_id) of docs (doc_id, text)."""
    words = docs.select("doc_id", word_list(F.col("text")).alias("words"))
    size = F.size("words")
    repeated = docs.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("again"), F.lit(True).alias("repeats"))
    if not (repeated := settle(repeated)).isEmpty():
        # rows of one id are one document, whose length no row knows
        words = words.join(_small(repeated), F.col("doc_id").eqNullSafe(F.col("again")), "left")
        size = F.when(F.col("repeats"), F.lit(2**31 - 1)).otherwise(size)
    held = words.select("doc_id", size.alias("n_words"), F.explode(shingle_hashes(F.col("words"), n)).alias("dh"))
    return held.join(_small(sketch), (F.col("dh") == F.col("h")) & (F.col("n_words") >= F.col("least"))).select("doc_id", "item_id").distinct()


def verify(docs: DataFrame, candidates: DataFrame, own: DataFrame, n: int = WORDS) -> DataFrame:
    """doc_id, item_id, item_shingles and shared of the candidate pairs that share `need` shingles."""
    pairs = candidates.select(F.col("doc_id").alias("c_doc"), F.col("item_id").alias("c_item"))
    texts = docs.join(_small(pairs.select("c_doc").distinct()), F.col("doc_id").eqNullSafe(F.col("c_doc")), "left_semi")
    held = texts.select("doc_id", F.explode(F.array_distinct(let(word_list(F.col("text")), lambda words: shingle_hashes(words, n)))).alias("dh"))
    both = held.join(_small(own.select("h", "item_id", "item_shingles", "need")), F.col("dh") == F.col("h"))
    met = both.join(_small(pairs), F.col("doc_id").eqNullSafe(F.col("c_doc")) & F.col("item_id").eqNullSafe(F.col("c_item")), "left_semi")
    counted = met.groupBy("doc_id", "item_id", "item_shingles", "need").agg(F.count_distinct("h").alias("shared"))
    return counted.where(F.col("shared") >= F.col("need"))


def leaks(docs: DataFrame, items: DataFrame, *, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, item_shingles, shared, containment of each pair with shared >= threshold * item_shingles.

    Shingles are of n lower-cased words; a text of fewer words is one shingle,
    an empty or null one has none and is in no pair.  Rows of one id count as
    one document or item, null ids too.  Repeated rows add nothing.
    """
    own = settle(item_shingles(items, item_id, item_text, n, threshold))
    rows = docs.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    candidates = settle(search(rows, sketches(own, threshold), n))
    found = verify(rows, candidates, own, n)
    return found.select("doc_id", "item_id", "item_shingles", "shared", (F.col("shared") / F.col("item_shingles")).alias("containment"))


def remove_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """docs without those that hold an item; rows with a null id stay if no null-id row holds one."""
    found = leaks(docs, items, **options).select(F.col("doc_id").alias("_leak")).distinct()
    rows = docs.select(F.struct("*").alias("_row"), F.col(f"`{options.get('id', 'doc_id')}`").alias("_id"))
    return rows.join(found, F.col("_id").eqNullSafe(F.col("_leak")), "left_anti").select("_row.*")


def remove_leaking_rows(docs: DataFrame, items: DataFrame, *, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """docs without the rows that hold an item, decided row by row: a row stays though another of its id, or of none, goes."""
    keyed = docs.select(row_key(id, text).alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = leaks(keyed, items, **options).select(F.col("doc_id").alias("_leak")).distinct()
    rows = docs.select(F.struct("*").alias("_row"), row_key(id, text).alias("_key"))
    return rows.join(found, F.col("_key") == F.col("_leak"), "left_anti").select("_row.*")


def op9_decontaminate(spark, sf_dir):
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP9_SQL = r"""
with w as (
  select 'd' as kind, doc_id as id, list_filter(string_split_regex(lower(coalesce(text, '')), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as ws from documents
  union all
  select 'i', item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') from benchmark),
s as (select distinct kind, id, array_to_string(ws[k:k + 4], ' ') as g from (select kind, id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as k from w where len(ws) > 0)),
n as (select id, count(*) as item_shingles from s where kind = 'i' group by id)
select d.id as doc_id, i.id as item_id, n.item_shingles, count(*) as shared, count(*) / n.item_shingles as containment
from s d join s i on d.g = i.g and d.kind = 'd' and i.kind = 'i' join n on n.id = i.id
group by d.id, i.id, n.item_shingles having count(*) >= ceil(n.item_shingles * 0.75)
"""
