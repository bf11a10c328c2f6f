"""Ontology parts from JSON files, in place of the built-in ones."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from loomgraph.ontology import Ontology


def _read(spark: SparkSession, path: str):
    rows = spark.read.option("wholetext", True).text(path).collect()  # one small file
    if len(rows) != 1:
        raise ValueError(f"{path} is not one file")
    return json.loads(rows[0][0])


def _named(items) -> dict[str, dict[str, str]]:
    if isinstance(items, dict):
        items = [{"label": k, **(v if isinstance(v, dict) else {})} for k, v in items.items()]
    return {x["label"]: {p["name"]: p.get("type", "STRING") for p in x.get("properties", [])} for x in items}


def present_files(spark: SparkSession, folder: str) -> dict[str, str | None]:
    """For each part of an ontology its file's name if the folder has it, else None."""
    path = lambda name: spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}.json")
    there = lambda p: p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    return {part: f"{part}.json" if there(path(part)) else None for part in ("entities", "relations", "triples", "views", "sections", "paths")}


def load_ontology(spark: SparkSession, folder: str, base: Ontology, *, entities="entities.json", relations="relations.json", triples="triples.json", views="views.json", sections="sections.json", paths="paths.json") -> Ontology:
    """base with the parts of those files; a name given as None keeps base's part.

    entities and relations are lists of objects with `label` and `properties`
    (or objects by label), triples lists of [subject, relation, object,
    sections, tier], views and paths objects by view, sections an object with
    `mappings` by role.  An empty list of entities, and sections without
    `mappings`, are errors.
    """
    part = lambda name: _read(spark, f"{folder.rstrip('/')}/{name}") if name else None
    found = {}
    if (x := part(entities)) is not None:
        if not x:
            raise ValueError(f"{entities} defines no entity")
        found["entities"] = _named(x)
    if (x := part(relations)) is not None:
        found["relations"] = list(_named(x))
    if (x := part(triples)) is not None:
        items = x if isinstance(x, list) else next(v for v in x.values() if isinstance(v, list))
        found["triples"] = [(t[0], t[1], t[2], list(t[3]) if len(t) > 3 else ["all"], t[4] if len(t) > 4 else "low") for t in items]
    if (x := part(views)) is not None:
        found["views"] = {v: list(labels) for v, labels in x.items() if isinstance(labels, list)}
    if (x := part(sections)) is not None:
        if not isinstance(x.get("mappings"), dict):
            raise ValueError(f"{sections} has no mappings")
        found["sections"] = {r: (m.get("doco_deo_type"), list(m.get("roles", []))) for r, m in x["mappings"].items()}
    if (x := part(paths)) is not None:
        found["paths"] = [(v, *t[:3]) for v, rows in x.items() if isinstance(rows, list) for t in rows if len(t) >= 3]
    return Ontology(**{**{f: getattr(base, f) for f in Ontology.__dataclass_fields__}, **found})
