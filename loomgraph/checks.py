"""Rules about a graph as queries for what breaks them, and reports on runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wrong_cardinality(nodes: DataFrame, edges: DataFrame, label: str, rel_type: str, *, direction: str = "out", least: int = 1, most: int = 1) -> DataFrame:
    """id, n of the nodes of a label whose edges of a type are fewer than least or more than most."""
    end = "src" if direction == "out" else "dst"
    counts = edges.where(F.col("rel_type") == rel_type).groupBy(F.col(end).alias("id")).agg(F.count("*").alias("n"))
    own = nodes.where(F.col("label") == label).select("id").join(counts, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))
    return own.where(~F.col("n").between(least, most))


def forbidden_edges(nodes: DataFrame, edges: DataFrame, rel_type: str, subject: str, obj: str) -> DataFrame:
    """Edges of a type between two labels."""
    s, d = (nodes.where(F.col("label") == x).select(F.col("id").alias(k)) for k, x in (("src", subject), ("dst", obj)))
    return edges.where(F.col("rel_type") == rel_type).join(s, "src", "left_semi").join(d, "dst", "left_semi")


def values_outside(rows: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    return rows.where(F.col(column).isNotNull() & ~F.col(column).isin(allowed))


def raise_if_any(violations: DataFrame, what: str) -> None:
    if (n := violations.count()) > 0:
        raise ValueError(f"{what}: {n} rows, such as {[r.asDict() for r in violations.limit(3).collect()]}")


def document_status(processed: DataFrame, *, doc: str = "filename", ok: str = "ok") -> DataFrame:
    """doc, status (success if at least one row is ok, else failed), n_ok."""
    return processed.groupBy(doc).agg(F.count_if(F.col(ok)).alias("n_ok")).select(doc, F.when(F.col("n_ok") > 0, "success").otherwise("failed").alias("status"), "n_ok")
