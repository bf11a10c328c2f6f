"""Low and mid paths over a ranked graph.

The published description leaves the builders' bodies open, so these are this
library's contracts.  A low path is one relation instance of a template of a
view, both ends entities: `mp_id` is a hash of view and relation, the text is
`source relation target`, and its rank the largest view rank of its ends,
where a missing rank falls back to the other views in their order.  A mid path
is a plan with its steps, or a container with its members.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.ontology import VIEWS
from loomgraph.storage import settle


def template_counts(templates: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """view, subject, relation, object, n: the instances of every template, 0 included.

    Edges are counted by signature first; the templates, as many as the
    ontology has, then pick their counts.  nodes is (id, label).
    """
    s, d = (nodes.select(F.col("id").alias(k), F.col("label").alias(name)) for k, name in (("src", "subject"), ("dst", "object")))
    counts = edges.join(s, "src").join(d, "dst").groupBy("subject", F.col("rel_type").alias("relation"), "object").agg(F.count("*").alias("n"))
    keys = ["subject", "relation", "object"]
    return counts.join(F.broadcast(templates), keys, "right").select("view", *keys, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def zero_templates(counted: DataFrame, first: int = 10) -> DataFrame:
    return counted.where("n = 0").orderBy("view", "subject", "relation", "object").limit(first)


def template_summary(counted: DataFrame) -> DataFrame:
    """view, matched, total, zero, instances."""
    return counted.groupBy("view").agg(F.count_if(F.col("n") > 0).alias("matched"), F.count("*").alias("total"), F.count_if(F.col("n") == 0).alias("zero"), F.sum("n").alias("instances"))


def rank_presence(centrality: DataFrame, column: str = "pagerank") -> DataFrame:
    """view, ranked: nodes with a rank in each view."""
    return centrality.groupBy("view").agg(F.count(column).alias("ranked"))


def preflight(counted: DataFrame, centrality: DataFrame, column: str = "pagerank") -> dict:
    """The totals; ValueError if no template has an instance or no node a rank."""
    rows = {r["view"]: r.asDict() for r in template_summary(counted).collect()}
    if not any(r["instances"] for r in rows.values()):
        raise ValueError("no template has an instance")
    if centrality.where(F.col(column).isNotNull()).limit(1).count() == 0:
        raise ValueError("no node has a rank")
    return rows


def best_rank(centrality: DataFrame, order: list[str] = VIEWS, column: str = "pagerank") -> DataFrame:
    """view, entity_id, rank for every view of `order`: the view's rank, else that of the first view that has one."""
    ranks = centrality.groupBy("entity_id").agg(*[F.max(F.when(F.col("view") == v, F.col(column))).alias(f"_{v}") for v in order])
    pairs = F.array(*[F.struct(F.lit(v).alias("view"), F.coalesce(f"_{v}", *[f"_{o}" for o in order if o != v], F.lit(None).cast("double")).alias("rank")) for v in order])
    return ranks.select("entity_id", F.inline(pairs)).where("rank is not null")


def low_paths(edges: DataFrame, nodes: DataFrame, templates: DataFrame, ranks: DataFrame) -> DataFrame:
    """mp_id, view, rel_id, src, dst, text, max_pagerank of each edge of each template.

    edges has rel_id, src, dst, rel_type; nodes id, label, name (an id without a
    name stands for itself); ranks view, entity_id, rank.
    """
    # one table of nodes with their ranks by view, met once from each end
    by_view = ranks.groupBy("entity_id").agg(F.map_from_entries(F.collect_list(F.struct("view", "rank"))).alias("ranks"))
    known = nodes.join(by_view, nodes["id"] == by_view["entity_id"], "left").select("id", "label", F.coalesce("name", "id").alias("name"), "ranks")
    end = lambda k, label: known.select(F.col("id").alias(k), F.col("label").alias(label), F.col("name").alias(f"{k}_name"), F.col("ranks").alias(f"{k}_ranks"))
    t = F.broadcast(templates.select("view", "subject", "relation", "object").distinct())
    # only edges of a template's type can be in a path
    types = F.broadcast(templates.select(F.col("relation").alias("rel_type")).distinct())
    hit = edges.join(types, "rel_type", "left_semi").join(end("src", "subject"), "src").join(end("dst", "object"), "dst").withColumnRenamed("rel_type", "relation").join(t, ["subject", "relation", "object"])
    rank = lambda k: F.try_element_at(f"{k}_ranks", F.col("view"))
    return hit.select(F.sha2(F.concat_ws("|", "view", "rel_id"), 256).alias("mp_id"), "view", "rel_id", "src", "dst", F.concat_ws(" ", "src_name", "relation", "dst_name").alias("text"), F.greatest(rank("src"), rank("dst")).alias("max_pagerank"))


def mid_paths(groups: DataFrame, ranks: DataFrame) -> DataFrame:
    """mp_id, view, counter, anchor_id, kind, n_members, text, max_pagerank of each anchor with a member.

    groups has view, kind (0 plan, 1 container), anchor_id, anchor_name,
    member_id, member_name.  Counters run from 1 in each view, plans first, then
    containers, by anchor.  The text lists the members by name and id.
    """
    rank = ranks.select("view", F.col("entity_id").alias("member_id"), "rank")
    members = groups.distinct().join(rank, ["view", "member_id"], "left")
    one = members.groupBy("view", "kind", "anchor_id", "anchor_name").agg(F.count("*").alias("n_members"), F.array_sort(F.collect_list(F.struct("member_name", "member_id"))).alias("m"), F.max("rank").alias("member_rank"))
    own = ranks.select("view", F.col("entity_id").alias("anchor_id"), F.col("rank").alias("anchor_rank"))
    out = one.join(own, ["view", "anchor_id"], "left")
    return number_by_view(out).select(
        F.sha2(F.concat_ws("|", "view", F.lit("mid"), "anchor_id"), 256).alias("mp_id"),
        "view",
        "counter",
        "anchor_id",
        "kind",
        "n_members",
        F.concat(F.coalesce("anchor_name", "anchor_id"), F.lit(": "), F.array_join(F.transform("m", lambda x: F.coalesce(x["member_name"], x["member_id"])), ", ")).alias("text"),
        F.greatest("anchor_rank", "member_rank").alias("max_pagerank"),
    )


def number_by_view(anchors: DataFrame) -> DataFrame:
    """anchors with counter, from 1 in each view by (kind, anchor_id).

    A view may hold most anchors, so they are dealt to tasks by ranges of the
    order, numbered there, and offset by what the ranges before hold of a view.
    """
    order = ["view", "kind", "anchor_id"]
    ranged = settle(anchors.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_range", F.shiftright("_at", 33))
    sizes = ranged.groupBy("view", "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("view").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    return ranged.join(before, ["view", "_range"]).withColumn("counter", (F.col("_at") - F.col("_first") + F.col("_before") + 1).cast("long")).drop("_at", "_range", "_first", "_before")


def link_paths(mid: DataFrame, low: DataFrame, from_chunk: DataFrame) -> DataFrame:
    """mid_id, low_id of one view where the anchor and an end of the low path share a chunk."""
    where = lambda k: from_chunk.select(F.col("entity_id").alias(k), F.col("chunk_id")).distinct()
    anchors = mid.select(F.col("mp_id").alias("mid_id"), "view", "anchor_id").join(where("anchor_id"), "anchor_id").select("mid_id", "view", "chunk_id")
    ends = low.select(F.col("mp_id").alias("low_id"), "view", F.explode(F.array("src", "dst")).alias("entity_id")).join(where("entity_id"), "entity_id").select("low_id", "view", "chunk_id").distinct()
    return anchors.join(ends, ["view", "chunk_id"]).select("mid_id", "low_id").distinct()


def details_of(links: DataFrame) -> DataFrame:
    """The inverse relation."""
    return links.select(F.col("low_id").alias("src"), F.col("mid_id").alias("dst"))


def path_counts(low: DataFrame, mid: DataFrame, links: DataFrame) -> DataFrame:
    tagged = low.select(F.lit("low").alias("k")).unionByName(mid.select(F.lit("mid").alias("k"))).unionByName(links.select(F.lit("link").alias("k")))
    return tagged.agg(F.count_if(F.col("k") == "low").alias("low_paths"), F.count_if(F.col("k") == "mid").alias("mid_paths"), F.count_if(F.col("k") == "link").alias("has_detail_path"))


def check_paths(low: DataFrame, mid: DataFrame, links: DataFrame, require_mid: bool = True) -> dict:
    """The counts, or ValueError: no low path, no mid path though required, no link, or a path without rank."""
    n = path_counts(low, mid, links).first().asDict()
    if n["low_paths"] == 0:
        raise ValueError("there is no low path")
    if require_mid and n["mid_paths"] == 0:
        raise ValueError("there is no mid path")
    if n["mid_paths"] and n["has_detail_path"] == 0:
        raise ValueError("no mid path is linked to a low path")
    if (bare := low.where("max_pagerank is null").count()) > 0:
        raise ValueError(f"{bare} low paths have no rank")
    return n


def path_sentences(paths: DataFrame, ask: Callable[[str], str] | None = None, attempts: int = 3, least: int = 20) -> DataFrame:
    """paths with query filled where it is null and there is a text.

    `ask(text)` is called up to `attempts` times for an answer of `least`
    characters; a shorter last one is kept, and a call that raises leaves null.
    Without `ask` the sentence is made from the text.
    """
    due = F.col("query").isNull() & F.col("text").isNotNull()
    if ask is None:
        return paths.withColumn("query", F.when(due, F.concat(F.lit("What is known about: "), "text", F.lit("?"))).otherwise(F.col("query")))

    def one(text: str):
        answer = None
        for _ in range(attempts):
            try:
                answer = ask(text)
            except Exception:  # noqa: BLE001  whatever a caller's model raises
                continue
            if answer and len(answer) >= least:
                break
        return answer or None

    def run(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            yield batch.assign(query=[one(t) for t in batch["text"]])

    asked = paths.where(due)
    return asked.mapInPandas(run, asked.schema).unionByName(paths.where(~due))


def path_embeddings(paths: DataFrame, embed: Callable[[list[str]], list[list[float]]] | None = None, dims: int = 64) -> DataFrame:
    """paths with embedding filled where it is null and there is a query.

    Without `embed` a text's vector counts its words by a hash, scaled to length 1.
    """
    due = F.col("embedding").isNull() & F.col("query").isNotNull()
    if embed is None:
        return paths.withColumn("embedding", F.when(due, hashed_vector(F.col("query"), dims)).otherwise(F.col("embedding")))

    def run(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            yield batch.assign(embedding=embed(batch["query"].tolist()))

    asked = paths.where(due)
    return asked.mapInPandas(run, asked.schema).unionByName(paths.where(~due))


def hashed_vector(text: F.Column, dims: int = 64) -> F.Column:
    cells = F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)), lambda w: F.pmod(F.xxhash64(w), F.lit(dims)).cast("int"))
    counts = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda k: F.size(F.filter(cells, lambda c: c == k)).cast("double"))
    norm = F.sqrt(F.aggregate(counts, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(counts, lambda x: F.when(norm > 0, x / norm).otherwise(x).cast("float"))
