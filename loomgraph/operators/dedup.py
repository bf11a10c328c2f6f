"""Exact duplicate chunks within a file: survivors, edges, chain, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LAST = 999_999  # the place of a chunk without index


def _named(chunks: DataFrame) -> DataFrame:
    return chunks.where(F.col("filename").isNotNull() & (F.col("filename") != ""))


def _key(chunks: DataFrame) -> F.Column:
    """A 256-bit digest of text and embedding, so long texts are not shuffled; null text equals null text."""
    vector = F.coalesce(F.to_json("embedding"), F.lit("no_embedding")) if "embedding" in chunks.columns else F.lit("no_embedding")
    return F.sha2(F.concat_ws("\u0000", F.when(F.col("text").isNull(), "n").otherwise("t"), F.coalesce("text", F.lit("")), vector), 256)


def _place() -> F.Column:
    return F.struct(F.coalesce("index", F.lit(LAST)).alias("place"), F.col("chunk_id"))


def duplicate_groups(chunks: DataFrame) -> DataFrame:
    """filename, text_key, survivor, copies of the groups with more than one chunk, most copies first.

    Chunks are equal if filename, text and embedding are; those without a
    filename are in no group.  The survivor has the least (index, chunk_id).
    """
    grouped = _named(chunks).groupBy("filename", _key(chunks).alias("text_key")).agg(F.min(_place()).alias("s"), F.count("*").alias("copies"))
    return grouped.where(F.col("copies") > 1).select("filename", "text_key", F.col("s.chunk_id").alias("survivor"), "copies").orderBy(F.desc("copies"), "filename", "survivor")


def survivors(chunks: DataFrame) -> DataFrame:
    """chunk_id, survivor of every chunk; its own survivor unless it is a duplicate.

    The least place of a group is found with partial aggregation and joined
    back, so a text that a third of the chunks share is no hot window.
    """
    keyed = chunks.select("chunk_id", "filename", _key(chunks).alias("text_key"))
    best = _named(chunks).groupBy("filename", _key(chunks).alias("text_key")).agg(F.min(_place()).alias("s"), F.count("*").alias("n")).where("n > 1").select("filename", "text_key", F.col("s.chunk_id").alias("survivor"))
    return keyed.join(best, ["filename", "text_key"], "left").select("chunk_id", F.coalesce("survivor", "chunk_id").alias("survivor"))


def drop_duplicates(chunks: DataFrame) -> DataFrame:
    gone = survivors(chunks).where(F.col("chunk_id") != F.col("survivor")).select("chunk_id")
    return chunks.join(gone, "chunk_id", "left_anti")


def repoint_edges(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """src, dst, rel_type, props after chunks were merged into their survivors.

    mapping has node, survivor of the merged nodes, and may have `place`, their
    order.  Edges of merged nodes move to the survivors; of those that then
    agree in src, dst and type one is left, whose props are folded in the order
    (untouched edge first, then place, src, dst), later values winning key by
    key.  Edges between nodes of one group go, but for a survivor's own loop.
    Edges that touch no merged node stay as they are, parallel ones too.
    """
    place = F.col("place") if "place" in mapping.columns else F.lit(0)
    merged = mapping.where(F.col("node") != F.col("survivor")).select("node", "survivor", place.cast("long").alias("place"))
    group = merged.select("node", "survivor").unionByName(merged.select(F.col("survivor").alias("node"), "survivor").distinct())
    s, d = (merged.select(F.col("node").alias(k), F.col("survivor").alias(f"_{k}"), F.col("place").alias(f"_{k}_place")) for k in ("src", "dst"))
    moved = edges.join(s, "src", "left").join(d, "dst", "left")
    touched = F.col("_src").isNotNull() | F.col("_dst").isNotNull()
    new = moved.select("src", "dst", F.coalesce("_src", "src").alias("new_src"), F.coalesce("_dst", "dst").alias("new_dst"), "rel_type", "props", touched.alias("touched"), F.greatest(F.coalesce("_src_place", F.lit(-1)), F.coalesce("_dst_place", F.lit(-1))).alias("place"))
    new = new.where(~(F.col("touched") & (F.col("new_src") == F.col("new_dst"))))
    hit = new.where("touched").select("new_src", "new_dst", "rel_type").distinct().withColumn("_hit", F.lit(True))
    new = new.join(hit, ["new_src", "new_dst", "rel_type"], "left")
    still = new.where(F.col("_hit").isNull()).select("src", "dst", "rel_type", "props")
    order = F.struct("touched", "place", "src", "dst", F.map_entries(F.coalesce("props", F.create_map().cast("map<string,string>"))).alias("entries"))
    # key by key the last edge that has the key wins
    rows = new.where("_hit").select(F.col("new_src").alias("src"), F.col("new_dst").alias("dst"), "rel_type", order.alias("o"))
    keys = rows.select("src", "dst", "rel_type", "o", F.explode_outer("o.entries").alias("e"))
    last = keys.groupBy("src", "dst", "rel_type", F.col("e.key").alias("key")).agg(F.max_by("e.value", F.struct("o.touched", "o.place", "o.src", "o.dst")).alias("value"))
    folded = last.groupBy("src", "dst", "rel_type").agg(F.map_from_entries(F.array_sort(F.filter(F.collect_list(F.struct("key", "value")), lambda kv: kv["key"].isNotNull()))).alias("props"))
    return still.unionByName(folded)


def next_chunks(chunks: DataFrame) -> DataFrame:
    """filename, src, dst of neighbours by (index, chunk_id), of chunks with index and filename."""
    order = Window.partitionBy("filename").orderBy("index", "chunk_id")
    pairs = _named(chunks).where(F.col("index").isNotNull()).select("filename", F.col("chunk_id").alias("src"), F.lead("chunk_id").over(order).alias("dst"))
    return pairs.where(F.col("dst").isNotNull())


def verify_merge(chunks: DataFrame, chain: DataFrame) -> DataFrame:
    """One row: chunk_count, next_chunk_relations, indexed_chunks, duplicate_groups_remaining, chain_complete.

    Remaining groups are counted by filename and text alone.  The chain is
    complete if it has an edge for each neighbour, or at most one chunk has an
    index.  An empty graph is all zeros and complete.
    """
    text = F.sha2(F.coalesce("text", F.lit("")), 256)
    left = _named(chunks).groupBy("filename", text.alias("t")).count().where("count > 1").agg(F.count("*").alias("duplicate_groups_remaining"))
    sizes = _named(chunks).where(F.col("index").isNotNull()).groupBy("filename").count()
    expected = sizes.agg(F.coalesce(F.sum(F.greatest(F.col("count") - 1, F.lit(0))), F.lit(0)).alias("expected"))
    counts = chunks.agg(F.count("*").alias("chunk_count"), F.count("index").alias("indexed_chunks"))
    edges = chain.agg(F.count("*").alias("next_chunk_relations"))
    row = counts.crossJoin(edges).crossJoin(left).crossJoin(expected)  # of one row each
    complete = (F.col("indexed_chunks") <= 1) | (F.col("next_chunk_relations") >= F.col("expected"))
    return row.select("chunk_count", "next_chunk_relations", "indexed_chunks", "duplicate_groups_remaining", complete.alias("chain_complete"))


def merge_report(before: DataFrame, after: DataFrame, chain: DataFrame) -> DataFrame:
    """One row: the counts before and after, merged, compression_percent, and success."""
    counts = before.agg(F.count("*").alias("original_chunks")).crossJoin(duplicate_groups(before).agg(F.count("*").alias("duplicate_groups"), F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("merged_chunks")))
    checked = verify_merge(after, chain)
    share = F.when(F.col("original_chunks") > 0, F.round((F.col("original_chunks") - F.col("chunk_count")) * 100.0 / F.col("original_chunks"), 2)).otherwise(F.lit(0.0))
    return counts.crossJoin(checked).select("original_chunks", "duplicate_groups", "merged_chunks", F.col("chunk_count").alias("final_chunks"), share.alias("compression_percent"), "duplicate_groups_remaining", "chain_complete", ((F.col("duplicate_groups_remaining") == 0) & F.col("chain_complete")).alias("success"))


def merge_chunks(chunks: DataFrame, chain: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The chunks without duplicates, and the chain: rebuilt only if there were any."""
    kept = drop_duplicates(chunks)
    any_gone = duplicate_groups(chunks).limit(1).count() > 0
    return kept, next_chunks(kept) if any_gone else chain
