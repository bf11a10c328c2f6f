"""Which views an entity belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NOT_ENTITIES = ["Chunk", "MetaPath"]


def label_views(mapping: DataFrame) -> DataFrame:
    """label, subgraphs: each label's views in the mapping's order (view_order, view, label)."""
    return mapping.groupBy("label").agg(F.transform(F.array_sort(F.collect_set(F.struct("view_order", "view"))), lambda v: v["view"]).alias("subgraphs"))


def mapping_differences(mapping: DataFrame, labels: DataFrame) -> DataFrame:
    """label, missing_in of the labels in only one of the two."""
    a, b = mapping.select("label").distinct(), labels.select("label").distinct()
    return a.join(b, "label", "left_anti").withColumn("missing_in", F.lit("ontology")).unionByName(b.join(a, "label", "left_anti").withColumn("missing_in", F.lit("mapping")))


def assign_views(entities: DataFrame, mapping: DataFrame) -> DataFrame:
    """entities with subgraphs and subgraph, which is null unless there is one view.

    An entity of several labels gets the views of its last label by name that
    has any; without a mapped label, or as a chunk or path, it keeps what it had.
    """
    table = F.broadcast(label_views(mapping).select(F.col("label").alias("_label"), F.col("subgraphs").alias("_views")))
    labels = F.coalesce("labels", F.array("label")) if "labels" in entities.columns else F.array("label")
    plain = entities.where(~F.arrays_overlap(labels, F.array(*map(F.lit, NOT_ENTITIES))))
    found = plain.select("entity_id", F.explode(labels).alias("_label")).join(table, "_label").groupBy("entity_id").agg(F.max_by("_views", "_label").alias("_views"))
    rest = [c for c in entities.columns if c not in ("subgraphs", "subgraph")]
    old = lambda c, t: F.col(c) if c in entities.columns else F.lit(None).cast(t)
    joined = entities.join(found, "entity_id", "left")
    one = F.when(F.size("_views") == 1, F.get("_views", F.lit(0)))
    return joined.select(*rest, F.coalesce("_views", old("subgraphs", "array<string>")).alias("subgraphs"), F.when(F.col("_views").isNotNull(), one).otherwise(old("subgraph", "string")).alias("subgraph"))


def view_stats(entities: DataFrame) -> DataFrame:
    """view, label, n of the assigned entities; label null sums the view, view null all entities with a view."""
    each = entities.select("entity_id", "label", F.explode("subgraphs").alias("view"))
    by = each.groupBy("view", "label").agg(F.count("*").alias("n"))
    views = by.groupBy("view").agg(F.sum("n").alias("n")).select("view", F.lit(None).cast("string").alias("label"), "n")
    total = entities.where(F.size("subgraphs") > 0).agg(F.count("*").alias("n")).select(F.lit(None).cast("string").alias("view"), F.lit(None).cast("string").alias("label"), "n")
    return by.unionByName(views).unionByName(total)


def uncovered(entities: DataFrame, mapping: DataFrame) -> DataFrame:
    """Entities whose label is mapped but which have no views."""
    known = mapping.select("label").distinct()
    return entities.where(F.col("subgraphs").isNull() & ~F.col("label").isin(NOT_ENTITIES)).join(F.broadcast(known), "label", "left_semi")


def checked_views(entities: DataFrame, mapping: DataFrame) -> DataFrame:
    """assign_views, or ValueError if no entity has a mapped label or one is left without views."""
    out = assign_views(entities, mapping)
    if out.where(F.size("subgraphs") > 0).limit(1).count() == 0:
        raise ValueError("no entity has a label that is in a view")
    if (left := uncovered(out, mapping).count()) > 0:
        raise ValueError(f"{left} entities with a known label are in no view")
    return out
