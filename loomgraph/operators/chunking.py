"""Documents to chunks with heading paths and roles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions.rules import canonical_section, role_from_answer, section_role
from loomgraph.functions.text import chunk_position, cosine, default_title, headings, let, path_at, record, split_by_structure, strip


def chunk_documents(docs: DataFrame, *, text: str = "text", chunk_size: int = 800, heading_size: int = 200, header_paths: bool = False, compat: bool = False) -> DataFrame:
    """docs without `text` but with a row, `chunk_id` and `chunk` for each chunk that is not blank.

    chunk_id is the chunk's place before blank ones are dropped, so it may have
    gaps.  With header_paths, `header_path` is the path of the last heading at
    or before the chunk, in the same row-local pass.
    """
    t = F.col(f"`{text}`")
    chunks = split_by_structure(t, chunk_size, heading_size)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    if not header_paths:
        return docs.select(*rest, F.posexplode(chunks).alias("chunk_id", "chunk")).where(strip(F.col("chunk")) != "")
    # all of it inside one expression, so that neither text nor headings are copied to, or worked out for, each chunk
    heads = record(found=headings(t), default=default_title(t))
    path = lambda x, c: let(chunk_position(t, c, compat), lambda p: F.when(p >= 0, path_at(x["found"], p, x["default"])).otherwise(x["default"]))
    placed = let(heads, lambda x: F.transform(chunks, lambda c: record(chunk=c, header_path=path(x, c))))
    rows = docs.select(*rest, F.posexplode(placed).alias("chunk_id", "_c"))
    return rows.select(*rest, "chunk_id", "_c.chunk", "_c.header_path").where(strip(F.col("chunk")) != "")


def document_headings(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """docs without `text` but with a row, offset, level, title and path for each heading."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    return docs.select(*rest, F.inline(headings(F.col(f"`{text}`"))))


def infer_roles(chunks: DataFrame, ask: Callable[[str, str], str] | None = None, *, header: str = "header_path", text: str = "text") -> DataFrame:
    """chunks with section_role: by rule, else what `ask(header, text)` answers, else Other.

    Only chunks that no rule decides are sent to `ask`.
    """
    ruled = chunks.withColumn("section_role", section_role(F.col(header), F.col(text)))
    if ask is None:
        return ruled.withColumn("section_role", F.coalesce("section_role", F.lit("Other")))

    def run(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            batch["section_role"] = [ask(h or "", t or "") for h, t in zip(batch[header], batch[text])]
            yield batch

    open_ = ruled.where(F.col("section_role").isNull())
    asked = open_.mapInPandas(run, open_.schema).withColumn("section_role", role_from_answer(F.col("section_role")))
    return ruled.where(F.col("section_role").isNotNull()).unionByName(asked)


def view_roles(chunks: DataFrame, priors: DataFrame, *, role: str = "section_role", views: tuple[str, ...] = ("MPU", "EBM", "EEM")) -> DataFrame:
    """chunks with the canonical role and view_roles: the role's prior views, else those of Other.

    priors (section_role, roles) is as small as the ontology and is broadcast.
    """
    fallback = priors.where(F.col("section_role") == "Other").agg(F.first("roles").alias("_other"))
    table = priors.select(F.col("section_role").alias("_role"), F.col("roles").alias("_roles"))
    named = chunks.withColumn(role, canonical_section(F.col(role)))
    joined = named.join(F.broadcast(table), F.col(role) == F.col("_role"), "left").crossJoin(F.broadcast(fallback))
    allowed = F.array(*map(F.lit, views))
    return joined.withColumn("view_roles", F.array_intersect(F.coalesce("_roles", "_other", F.array().cast("array<string>")), allowed)).drop("_role", "_roles", "_other")


def semantic_groups(sentences: DataFrame, *, by: list[str], order: list[str], embedding: str = "embedding", threshold: float = 0.72, window: int = 1) -> DataFrame:
    """sentences with similarity, is_break and group.

    similarity is the cosine with the mean of the up to `window` sentences
    before; a sentence breaks off a new group (numbered from 0) where it is
    below the threshold.  The first never does, nor does one without similarity.
    """
    place = Window.partitionBy(*by).orderBy(*order)
    if window == 1:
        before = F.lag(embedding).over(place)
    else:
        seen = F.collect_list(embedding).over(place.rowsBetween(-window, -1))
        # a sum has the mean's direction
        before = F.aggregate(F.slice(seen, F.lit(2), F.lit(window)), F.transform(F.get(seen, F.lit(0)), lambda x: x.cast("double")), lambda s, v: F.zip_with(s, v, lambda x, y: x + y.cast("double")))
    with_sim = sentences.withColumn("similarity", cosine(F.col(embedding), before))
    broken = with_sim.withColumn("is_break", F.coalesce((F.col("similarity") < threshold).cast("int"), F.lit(0)))
    return broken.withColumn("group", F.sum("is_break").over(place.rowsBetween(Window.unboundedPreceding, 0)))


def resplit(chunks: DataFrame, embed: Callable[[list[str]], list[list[float]]], *, doc: str = "filename", text: str = "chunk", threshold: float = 0.72, window: int = 2) -> DataFrame:
    """chunks (doc, chunk_id, text, ...) cut again where the meaning changes; chunk_id numbers a document's new chunks from 0.

    The sentences of a chunk are embedded in batches on the executors; each that
    is less like the mean of the `window` before it than the threshold begins a
    new chunk.  Other columns go with every piece.  A chunk without sentences
    stays whole.
    """
    rest = [c for c in chunks.columns if c not in (text, "chunk_id")]
    sentences = F.when(F.size(split_sentences(F.col(text))) > 0, split_sentences(F.col(text))).otherwise(F.array(F.col(text)))
    rows = chunks.select(doc, "chunk_id", F.struct(*rest).alias("_rest"), F.posexplode(sentences).alias("_place", "_sentence"))

    def run(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            batch["embedding"] = [[float(x) for x in v] for v in embed(batch["_sentence"].tolist())] if len(batch) else []
            yield batch[[doc, "chunk_id", "_place", "_sentence", "embedding"]]

    kinds = dict(rows.dtypes)
    embedded = rows.select(doc, "chunk_id", "_place", "_sentence").mapInPandas(run, f"`{doc}` {kinds[doc]}, chunk_id {kinds['chunk_id']}, _place int, _sentence string, embedding array<float>")
    found = semantic_groups(embedded, by=[doc, "chunk_id"], order=["_place"], threshold=threshold, window=window)
    pieces = found.groupBy(doc, "chunk_id", "group").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_place", "_sentence"))), lambda x: x["_sentence"]), " ").alias(text))
    old = chunks.select(doc, "chunk_id", *[c for c in rest if c != doc])
    number = F.row_number().over(Window.partitionBy(doc).orderBy("chunk_id", "group")) - 1
    return pieces.join(old, [doc, "chunk_id"]).withColumn("_new", number.cast(kinds["chunk_id"])).select(*[F.col("_new").alias("chunk_id") if c == "chunk_id" else F.col(c) for c in chunks.columns])


def split_sentences(text) -> F.Column:
    """Sentences of a text: pieces that end with . ! ? or their full-width forms, stripped, without empty ones."""
    return F.filter(F.transform(F.split(text, r"(?<=[.!?。！？])\s*"), strip), lambda s: s != "")


def join_text(nodes: DataFrame, *, by: list[str], order: list[str], text: str = "text") -> DataFrame:
    """by, joined: the stripped texts that are not blank, in order, with a blank line between.

    One text for each group is the result asked for, so a group is one row.
    """
    rows = nodes.select(*by, F.struct(*order, strip(F.coalesce(F.col(text), F.lit(""))).alias("_text")).alias("_row")).where(F.col("_row._text") != "")
    return rows.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list("_row")), lambda r: r["_text"]), "\n\n").alias("joined"))
