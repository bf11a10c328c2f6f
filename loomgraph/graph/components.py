"""Weakly connected components by alternating large-star and small-star steps.

Each step joins edges with their node's least neighbour, so the work of a round
is proportional to the edges, and the rounds to the logarithm of the longest
path.  No node's neighbours are ever gathered into one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.storage import drop_settled, settle


def _star(edges: DataFrame, large: bool) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("own"), F.least("m", "u").alias("m"))
    met = edges.join(least, F.col("u") == F.col("own"))
    if large:
        out = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("own").alias("u"), F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node with an edge to another node; component is its least node.

    Direction, repeats and self-loops do not matter; edges with a null end are left out.
    """
    pairs = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"), F.col(src).alias("_s"), F.col(dst).alias("_d")).where(F.col("_s").isNotNull() & F.col("_d").isNotNull() & (F.col("u") != F.col("v")))
    now = settle(pairs.select("u", "v").distinct())
    state = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nxt = settle(_star(_star(both, True), False))
        seen = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_settled(now)
        now = nxt
        if tuple(seen) == state:
            break
        state = tuple(seen)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
