"""Markdown folders with metadata sidecars, and the choice of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUIRED = ["dc_title", "dc_author", "dc_publisher"]
SIDECAR = "base string, dc_title string, dc_author string, dc_publisher string, dc_creator string, dc_type string, dc_language string, dc_subject string, dcterms_issued string, dcterms_identifier string, source string, source_filename string, processed_at string"
_FIELDS = [f.split()[0] for f in SIDECAR.split(", ")][1:]


def read_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """filename, text of every *.md file of a folder; none if there is no such folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path) or not system.getFileStatus(path).isDirectory():
        return spark.createDataFrame([], "filename string, text string")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(folder)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"), F.decode("content", "UTF-8").alias("text"))


def list_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The file names, sorted."""
    return read_markdown(spark, folder).select("filename").orderBy("filename")


def read_sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each *_metadata.json of a folder; base is its file name without that ending."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*_metadata.json").load(folder)
    fields = ", ".join(f"{f} string" for f in _FIELDS)
    parsed = files.select(F.regexp_extract("path", r"([^/]+)_metadata\.json$", 1).alias("base"), F.from_json(F.decode("content", "UTF-8"), fields).alias("m"))
    return parsed.select("base", "m.*")


def with_metadata(docs: DataFrame, sidecars: DataFrame) -> DataFrame:
    """docs (with filename) and the metadata of the sidecar of its base name.

    A sidecar counts only if it has a title, an author and a publisher; else
    all fields are defaults.  Of several for one base the least row counts.
    """
    one = sidecars.groupBy("base").agg(F.min(F.struct(*_FIELDS)).alias("m")).select("base", "m.*")
    base = F.regexp_replace("filename", r"\.md$", "")
    full = F.lit(True)
    for c in REQUIRED:
        full = full & F.coalesce(F.col(c) != "", F.lit(False))
    defaults = {"dc_title": base, "dc_type": F.lit("Research Article"), "dc_language": F.lit("unknown"), "dcterms_identifier": F.concat(F.lit("local:"), "filename"), "dc_author": F.lit("Unknown"), "dc_publisher": F.lit("Unknown"), "dc_creator": F.lit("Unknown"), "dcterms_issued": F.lit("Unknown"), "source_filename": F.col("filename")}
    joined = docs.withColumn("_base", base).join(one, F.col("_base") == F.col("base"), "left")
    kept = [f"`{c}`" for c in docs.columns if c not in _FIELDS]
    return joined.select(*kept, *[F.when(full, F.col(f)).otherwise(defaults.get(f, F.lit(None).cast("string"))).alias(f) for f in _FIELDS])


def select_documents(docs: DataFrame, selected: list[str] | None = None, max_docs: int | None = None) -> DataFrame:
    """Those of an allow-list, which wins, or the first max_docs by filename; all if max_docs is no number over 0."""
    if selected:
        names = docs.sparkSession.createDataFrame([(s,) for s in dict.fromkeys(selected)], "filename string")
        return docs.join(names, "filename", "left_semi")
    if isinstance(max_docs, int) and not isinstance(max_docs, bool) and max_docs > 0:
        return docs.orderBy("filename").limit(max_docs)
    return docs


def effective_count(docs: DataFrame, max_docs: int | None = None) -> int:
    total = docs.count()
    return min(total, max_docs) if isinstance(max_docs, int) and not isinstance(max_docs, bool) and max_docs > 0 else total
