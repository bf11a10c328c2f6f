"""Schema-guided extraction: routing, the extractor contract, conformance."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.rules import canonical_section
from loomgraph.functions.text import strip
from loomgraph.operators.chunking import join_text

CONTRACT = "nodes array<struct<id:string,label:string,properties:map<string,string>>>, relationships array<struct<type:string,start_node_id:string,end_node_id:string,properties:map<string,string>>>"


def allowed_sections(sections: F.Column) -> F.Column:
    """null for all sections (none given, or one is `all` in any case), else the canonical roles."""
    everything = (F.size(F.coalesce(sections, F.array().cast("array<string>"))) == 0) | F.exists(sections, lambda s: F.lower(s) == "all")
    return F.when(~everything, F.array_distinct(F.transform(sections, canonical_section)))


def usable_templates(templates: DataFrame, entity_labels: DataFrame, relation_types: DataFrame) -> DataFrame:
    """Templates whose two labels and relation are all defined."""
    labels = entity_labels.select("label").distinct()
    out = templates
    for end in ("subject", "object"):
        out = out.join(F.broadcast(labels.select(F.col("label").alias(end))), end, "left_semi")
    return out.join(F.broadcast(relation_types.select(F.col("rel_type").alias("relation")).distinct()), "relation", "left_semi").select(*templates.columns)


def route(chunks: DataFrame, templates: DataFrame, *, doc: str = "filename") -> DataFrame:
    """doc, template_id, joined: for each template the text of the document's chunks in its sections.

    The templates are as many as the ontology has and are broadcast.  Routing
    looks at a document's distinct roles first: chunk texts are joined once for
    each distinct set of roles that a template asks for, not once a template.
    """
    asked = templates.select("template_id", F.array_sort(allowed_sections(F.col("sections"))).alias("allowed"))
    kinds = asked.select(F.coalesce("allowed", F.array().cast("array<string>")).alias("allowed")).distinct()
    picked = chunks.join(F.broadcast(kinds), (F.size("allowed") == 0) | F.array_contains("allowed", F.col("section_role")))
    texts = join_text(picked, by=[doc, "allowed"], order=["index"])
    keyed = asked.withColumn("allowed", F.coalesce("allowed", F.array().cast("array<string>")))
    return texts.join(F.broadcast(keyed), "allowed").select(doc, "template_id", "joined").where(F.col("joined") != "")


def extract(routed: DataFrame, templates: DataFrame, extractor: Callable[[str, tuple[str, str, str]], str], *, doc: str = "filename", retries: int = 2, transient: tuple[type[Exception], ...] = (Exception,)) -> DataFrame:
    """doc, template_id, output, error: what extractor(text, (subject, relation, object)) gave, as JSON.

    A call that raises a transient error is repeated up to `retries` times; then,
    and after any other error at once, output is null and error has the
    message, and other calls go on.
    """

    def run(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            outputs, errors = [], []
            for text, a, r, b in zip(batch["joined"], batch["subject"], batch["relation"], batch["object"]):
                output = error = None
                for _ in range(retries + 1):
                    try:
                        output, error = extractor(text, (a, r, b)), None
                        break
                    except Exception as e:  # noqa: BLE001  whatever a caller's model raises
                        error = f"{type(e).__name__}: {e}"
                        if not isinstance(e, transient):
                            break
                outputs.append(output)
                errors.append(error)
            yield pd.DataFrame({doc: batch[doc], "template_id": batch["template_id"], "output": outputs, "error": errors})

    rows = routed.join(F.broadcast(templates.select("template_id", "subject", "relation", "object")), "template_id")
    return rows.mapInPandas(run, f"{doc} {dict(routed.dtypes)[doc]}, template_id int, output string, error string")


def dictionary_extractor(names: dict[str, list[str]]) -> Callable[[str, tuple[str, str, str]], str]:
    """An extractor by rule: a name that stands in the text, letter case aside, is an entity of its label, and each two that a template joins are related."""

    def held(text: str, label: str) -> list[str]:
        return [n for n in names.get(label, []) if re.search(rf"(?<!\w){re.escape(n.lower())}(?!\w)", text.lower())]

    def extractor(text: str, triple: tuple[str, str, str]) -> str:
        subject, relation, obj = triple
        node = lambda label, n: {"id": f"{label}:{n}", "label": label, "properties": {"WHU_HASNAME": n, "WHU_HASORIGINALTEXT": n}}
        a, b = held(text, subject), held(text, obj)
        nodes = {x["id"]: x for x in [*(node(subject, n) for n in a), *(node(obj, n) for n in b)]} if a and b else {}
        edges = [{"type": relation, "start_node_id": f"{subject}:{x}", "end_node_id": f"{obj}:{y}", "properties": {}} for x in a for y in b if (subject, x) != (obj, y)]
        return json.dumps({"nodes": list(nodes.values()), "relationships": edges})

    return extractor


def parse_outputs(outputs: DataFrame, *, doc: str = "filename", output: str = "output") -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the JSON contract; local ids get `<doc>|<template_id>|` in front.

    Output that is no JSON of the contract gives nothing.
    """
    parsed = outputs.withColumn("_o", F.from_json(output, CONTRACT))
    prefix = lambda local: F.concat_ws("|", F.col(doc).cast("string"), F.col("template_id").cast("string"), local)
    nodes = parsed.select(doc, "template_id", F.explode("_o.nodes").alias("n")).where("n.id is not null and n.label is not null")
    nodes = nodes.select(doc, "template_id", prefix(F.col("n.id")).alias("entity_id"), F.col("n.label").alias("label"), F.col("n.properties").alias("props"))
    edges = parsed.select(doc, "template_id", F.explode("_o.relationships").alias("r")).where("r.type is not null and r.start_node_id is not null and r.end_node_id is not null")
    edges = edges.select(doc, "template_id", prefix(F.col("r.start_node_id")).alias("src"), prefix(F.col("r.end_node_id")).alias("dst"), F.col("r.type").alias("rel_type"), F.col("r.properties").alias("props"))
    return nodes, edges


def conforming(nodes: DataFrame, edges: DataFrame, templates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with a label of their template's, and edges with its type and direction between such nodes."""
    t = F.broadcast(templates.select("template_id", "subject", "relation", "object"))
    good = nodes.join(t, "template_id").where(F.col("label").isin(F.col("subject"), F.col("object"))).select(*nodes.columns)
    label = lambda end: good.select("template_id", F.col("entity_id").alias(end), F.col("label").alias(f"_{end}"))
    kept = edges.join(label("src"), ["template_id", "src"]).join(label("dst"), ["template_id", "dst"]).join(t, "template_id").where((F.col("rel_type") == F.col("relation")) & (F.col("_src") == F.col("subject")) & (F.col("_dst") == F.col("object")))
    return good, kept.select(*edges.columns)


def rule_extract(chunks: DataFrame, dictionary: DataFrame, templates: DataFrame, *, chunk: str = "chunk_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Mentions (chunk, entity_id, label) and edges (chunk, src, rel_type, dst) by rule, in place of a model.

    An entity (entity_id, label, name of one word) is mentioned where its name
    is a word of the text, letter case aside; an edge joins two mentions of a
    chunk whose labels a template allows.
    """
    words = chunks.select(chunk, F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1)))).alias("word"))
    names = dictionary.select("entity_id", "label", F.lower(strip(F.col("name"))).alias("word"))
    mentions = words.join(names, "word").select(chunk, "entity_id", "label").distinct()
    t = F.broadcast(templates.select("subject", "relation", "object").distinct())
    starts = mentions.join(t, mentions["label"] == t["subject"]).select(chunk, F.col("entity_id").alias("src"), "relation", "object")
    ends = mentions.select(chunk, F.col("entity_id").alias("dst"), F.col("label").alias("object"))
    edges = starts.join(ends, [chunk, "object"]).where(F.col("src") != F.col("dst")).select(chunk, "src", F.col("relation").alias("rel_type"), "dst").distinct()
    return mentions, edges
