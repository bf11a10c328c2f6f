"""Intermediate results that outlive executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share; a temporary one where it is unset and the master is local."""
    if where := spark.conf.get("spark.checkpoint.dir", None):
        return where
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="loomgraph-")
    return _own[app]


#: Shuffle files go when the execution that wrote them ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and a lost executor costs nothing.

    The files go when the driver's file system closes, or by `drop_settled`.
    The shuffle files of the write go with it, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/settled-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def drop_settled(df: DataFrame) -> None:
    """Remove the files of a frame that `settle` gave and that nothing reads any more."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles() if "/settled-" in f}:
        place = spark._jvm.org.apache.hadoop.fs.Path(name)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
