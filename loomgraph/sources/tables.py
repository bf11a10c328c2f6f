"""Keyed upserts, deletes and logs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: list[str], fill: bool = False) -> DataFrame:
    """old with the rows of new; on equal keys new wins, or with fill only where it is not null.

    Keys are compared null-safely; new must not repeat a key.
    """
    if not fill:
        return old.join(new.select(*[F.col(k).alias(f"_{k}") for k in keys]), [old[k].eqNullSafe(F.col(f"_{k}")) for k in keys], "left_anti").unionByName(new, allowMissingColumns=True)
    a, b = old.alias("a"), new.alias("b")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    return a.join(b, on, "full").select(*[F.coalesce(f"b.{c}", f"a.{c}").alias(c) if c in new.columns else F.col(f"a.{c}") for c in old.columns])


def delete(old: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return old.join(gone.select(*keys).distinct(), keys, "left_anti")


def write_log(events: DataFrame, path: str, header: dict, summary: dict) -> None:
    """A text log: a header line, one line for each event in order of seq, `=== END ===` and the summary."""
    lines = events.select(F.col("seq").cast("long").alias("seq"), F.to_json(F.struct(*[c for c in events.columns if c != "seq"])).alias("value"))
    spark = events.sparkSession
    ends = spark.createDataFrame([(-1, json.dumps(header, sort_keys=True)), (2**62, "=== END ==="), (2**62 + 1, json.dumps(summary, sort_keys=True))], "seq long, value string")
    lines.unionByName(ends).orderBy("seq").select("value").coalesce(1).write.mode("append").text(path)
