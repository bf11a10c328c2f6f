"""Entity resolution: equal names, and masters of similar entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.graph.components import connected_components


def canonical_ids(entities: DataFrame, keys: list[str], id: str = "entity_id") -> DataFrame:
    """id, canonical: the least id of the entities equal in all keys; with a null key an entity is its own.

    The least id is an aggregate that is joined back, so a name however common is no hot window.
    """
    least = entities.dropna(subset=keys).groupBy(*keys).agg(F.min(id).alias("canonical"))
    return entities.join(least, keys, "left").select(id, F.coalesce("canonical", id).alias("canonical"))


def resolve_exact(entities: DataFrame, relations: DataFrame, keys: list[str] | None = None, id: str = "entity_id") -> tuple[DataFrame, DataFrame]:
    """Entities merged by label and name, and relations between the survivors.

    The entity of the least id survives with its own properties.  Relations of
    equal ends and type become the one of the least rel_id.
    """
    same = canonical_ids(entities, keys or ["label", "name"], id)
    gone = same.where(F.col(id) != F.col("canonical"))
    kept = entities.join(gone.select(id), id, "left_anti")
    to = lambda c: gone.select(F.col(id).alias(c), F.col("canonical").alias(f"_{c}"))
    moved = relations.join(to("src"), "src", "left").join(to("dst"), "dst", "left").withColumns({"src": F.coalesce("_src", "src"), "dst": F.coalesce("_dst", "dst")}).select(*relations.columns)
    first = moved.groupBy("src", "dst", "rel_type").agg(F.min_by(F.struct(*relations.columns), "rel_id").alias("r")).select("r.*")
    return kept, first


def component_masters(similar: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """component_id, member_id of the components of more than one member; members, if given, restricts both ends."""
    edges = similar.select("src", "dst")
    if members is not None:
        for end in ("src", "dst"):
            edges = edges.join(members.select(F.col("entity_id").alias(end)).distinct(), end, "left_semi")
    return connected_components(edges).select(F.col("component").alias("component_id"), F.col("node").alias("member_id"))


def master_stats(masters: DataFrame) -> DataFrame:
    return masters.agg(F.count_distinct("component_id").alias("masters"), F.count("*").alias("links"))
