"""The staged build: which stages run, in which order, with events and retries."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import functions as F

from loomgraph.functions.text import strip
from loomgraph.graph.centrality import centrality, project
from loomgraph.model import DC, KnowledgeGraph
from loomgraph.ontology import CONTAINER_LABELS, PLAN_LABELS, VIEWS, Ontology, default_ontology, problems
from loomgraph.operators import chunking, dedup, extraction, metadata, resolve, retrieval, views
from loomgraph.plans import paths
from loomgraph.sources.config import Settings, callable_named
from loomgraph.sources.markdown import read_markdown, read_sidecars, select_documents, with_metadata
from loomgraph.sources.ontology_files import load_ontology, present_files
from loomgraph.storage import settle

STAGES = ["clear", "build_kg", "subgraph_annotate", "chunk_merge", "entity_merge", "pagerank", "metapath"]
#: Clearing and merging entities are off unless asked for.
DEFAULT_ON = {"build_kg": True, "subgraph_annotate": True, "chunk_merge": True, "pagerank": True, "metapath": True}
EVENT = "run_id string, seq long, type string, stage string, index int, total int, message string"


def plan_stages(flags: dict[str, bool] | None = None, only: list[str] | None = None, skip: list[str] = ()) -> list[str]:
    """The stages to run, in their order.  A stage named in `only` runs whatever its flag says; `skip` wins."""
    if unknown := sorted({*(only or []), *skip} - set(STAGES)):
        raise ValueError(f"unknown stages: {unknown}")
    on = DEFAULT_ON | {k: v for k, v in (flags or {}).items() if k in STAGES}
    return [s for s in STAGES if s not in skip and (s in only if only is not None else on.get(s, False))]


@dataclass
class Build:
    """One build at a time over a graph; call `run`, and `cancel` from another thread."""

    spark: object
    settings: Settings = field(default_factory=Settings)
    ontology: Ontology = field(default_factory=default_ontology)
    extractor: Callable[[str, tuple[str, str, str]], str] | None = None
    ask_role: Callable[[str, str], str] | None = None
    ask_sentence: Callable[[str], str] | None = None
    embed: Callable[[list[str]], list[list[float]]] | None = None
    listeners: list[Callable[[dict], None]] = field(default_factory=list)
    #: Errors of the extractor after which a call is repeated; others fail it at once.
    transient: tuple[type[Exception], ...] = (ConnectionError, TimeoutError, OSError)

    def __post_init__(self):
        self._lock, self._cancel, self.events, self.results = threading.Lock(), threading.Event(), [], {}
        self.graph = KnowledgeGraph.load(self.spark, self.settings.graph) if self.settings.graph else KnowledgeGraph.empty(self.spark)
        self.frames = self.ontology.frames(self.spark)
        self.postings = None

    @classmethod
    def from_settings(cls, spark, settings: Settings, **given) -> "Build":
        """A build with the functions and the ontology that the settings name; `given` wins."""
        named = {k: callable_named(getattr(settings, k)) for k in ("extractor", "ask_role", "ask_sentence", "embed")}
        if named["extractor"] is None and settings.dictionary:
            with open(settings.dictionary, encoding="utf-8") as f:
                named["extractor"] = extraction.dictionary_extractor(json.load(f))
        if settings.schema_dir:
            named["ontology"] = load_ontology(spark, settings.schema_dir, default_ontology(), **present_files(spark, settings.schema_dir))
        return cls(spark, settings, **(named | given))

    def cancel(self) -> None:
        self._cancel.set()

    def _emit(self, kind: str, **fields) -> None:
        event = {"run_id": self.run_id, "seq": len(self.events), "type": kind, "stage": None, "index": None, "total": None, "message": None} | fields
        self.events.append(event)
        for listener in list(self.listeners):
            listener(event)

    def events_frame(self):
        return self.spark.createDataFrame([tuple(e.values()) for e in self.events], EVENT)

    def run(self, only: list[str] | None = None, skip: list[str] = (), run_id: str | None = None, flags: dict[str, bool] | None = None) -> dict:
        """Run the planned stages; the first that fails ends the run and its error goes on.

        flags switch stages on or off for this run, over those of the settings.  A second run while one goes on is a RuntimeError.  Cancelling takes
        effect before the next stage.
        """
        if not self._lock.acquire(blocking=False):
            raise RuntimeError("a build is running")
        try:
            self.run_id, self.events, self.results, began = run_id or f"run-{time.time_ns()}", [], {}, time.time()
            self._cancel.clear()
            planned = plan_stages(self.settings.stages | (flags or {}), only, skip)
            if wrong := problems(self.ontology)["errors"]:
                raise ValueError("; ".join(wrong))
            for k, stage in enumerate(planned, 1):
                if self._cancel.is_set():
                    self._emit("cancelled")
                    break
                self._emit("stage_start", stage=stage, index=k, total=len(planned))
                try:
                    self.results[stage] = getattr(self, f"_{stage}")()
                except Exception as e:
                    self._emit("error", stage=stage, message=f"{type(e).__name__}: {e}")
                    raise
                self._emit("stage_done", stage=stage, index=k, total=len(planned))
            summary = self.summary(planned, began)
            if not self._cancel.is_set():
                self._emit("complete", message=str(summary))
            return summary
        finally:
            self._lock.release()

    def summary(self, planned: list[str], began: float) -> dict:
        built = self.results.get("build_kg", {})
        return self.graph.stats().first().asDict() | {
            "duration_sec": round(time.time() - began, 2),
            "stages_run": [s for s in planned if s in self.results],
            "stages_failed": [s for s in planned if s not in self.results],
            "stages_total": len(planned),
            **{k: built.get(k) for k in ("entities", "relations", "documents", "succeeded_docs", "failed_docs")},
        }

    def _clear(self) -> dict:
        self.graph = self.graph.cleared()
        return {}

    def _build_kg(self) -> dict:
        docs = select_documents(read_markdown(self.spark, self.settings.data_dir), self.settings.selected_files, self.settings.max_docs)
        docs = with_metadata(docs, read_sidecars(self.spark, self.settings.data_dir))
        chunks = chunking.chunk_documents(docs.select("filename", "text"), chunk_size=self.settings.chunk_size, header_paths=True)
        if self.embed is not None:
            chunks = settle(chunking.resplit(chunks, self.embed, threshold=self.settings.similarity_threshold, window=self.settings.semantic_window))
        chunks = chunking.infer_roles(chunks.withColumnRenamed("chunk", "text"), self.ask_role)
        chunks = settle(chunking.view_roles(chunks, self.frames["section_prior"]))
        chunks = chunks.select(F.concat_ws("#", "filename", "chunk_id").alias("chunk_id"), "filename", F.col("chunk_id").alias("index"), "text", "header_path", "section_role", "view_roles")
        templates = extraction.usable_templates(self.frames["triple_template"], self.frames["entity_def"], self.frames["relation_def"])
        graph = KnowledgeGraph.empty(self.spark)
        status = docs.select("filename").withColumn("ok", F.lit(True))
        if self.extractor is not None:
            routed = extraction.route(chunks, templates)
            out = settle(extraction.extract(routed, templates, self.extractor, retries=self.settings.doc_max_retries, transient=self.transient))
            status = out.select("filename", F.col("error").isNull().alias("ok")).unionByName(docs.select("filename").withColumn("ok", F.lit(False)))
            nodes, edges = extraction.conforming(*extraction.parse_outputs(out), templates)
            named = nodes.withColumns({"name": F.try_element_at("props", F.lit("WHU_HASNAME")), "original_text": F.try_element_at("props", F.lit("WHU_HASORIGINALTEXT")), "llm_weight": F.try_element_at("props", F.lit("llm_weight")).try_cast("double")})
            entities = named.dropDuplicates(["entity_id"])
            said = F.lower(strip(F.coalesce("original_text", "name")))
            held = named.join(chunks.select("chunk_id", "filename", F.lower("text").alias("_text")), "filename").where(F.contains("_text", said)).select("entity_id", "chunk_id").distinct()
            rel = edges.withColumns({"rel_id": F.sha2(F.concat_ws("|", "src", "rel_type", "dst"), 256), "name": F.try_element_at("props", F.lit("WHU_HASNAME")), "original_text": F.try_element_at("props", F.lit("WHU_HASORIGINALTEXT")), "llm_weight": F.try_element_at("props", F.lit("llm_weight")).try_cast("double")}).dropDuplicates(["rel_id"])
            graph = graph.with_(entities=_shaped(graph.entities, entities.withColumn("labels", F.array("label"))), relations=_shaped(graph.relations, rel), from_chunk=held)
        full = _shaped(graph.chunks, chunks)
        stored, filled = self.graph.chunks.where("filename is null"), 0
        if not stored.isEmpty():
            # chunks that another tool stored without their file: they take what the chunks that they hold know
            nodes = chunks.select(F.xxhash64("chunk_id").alias("ordinal"), "filename", "text", "header_path", "section_role", "view_roles")
            found, matches = metadata.backfill_chunks(stored, nodes)
            full, filled = full.unionByName(_shaped(graph.chunks, found)), matches.first()["matches"]
        meta = docs.select("filename", *DC)
        full = settle(metadata.chunk_metadata(full, meta))
        entities = settle(metadata.enhance_entities(metadata.entity_metadata(graph.entities, graph.from_chunk, full)))
        relations = metadata.relation_metadata(graph.relations, graph.from_chunk, full)
        relations = settle(metadata.enhance_relations(relations, entities, graph.from_chunk, full))
        self.graph = graph.with_(chunks=full, entities=entities, relations=relations, from_chunk=settle(graph.from_chunk), next_chunk=settle(dedup.next_chunks(full)))
        counts = status.groupBy("filename").agg(F.max("ok").alias("ok")).agg(F.count("*").alias("documents"), F.count_if("ok").alias("succeeded_docs")).first()
        return {"documents": counts["documents"], "succeeded_docs": counts["succeeded_docs"], "failed_docs": counts["documents"] - counts["succeeded_docs"], "entities": entities.count(), "relations": relations.count(), "backfilled": filled}

    def _subgraph_annotate(self) -> dict:
        self.graph = self.graph.with_(entities=settle(views.checked_views(self.graph.entities, self.frames["view_mapping"])))
        return {"assigned": self.graph.entities.where(F.size("subgraphs") > 0).count()}

    def _chunk_merge(self) -> dict:
        before = self.graph.chunks
        to = settle(dedup.survivors(before))
        kept, chain = dedup.merge_chunks(before, self.graph.next_chunk)
        held = self.graph.from_chunk.join(to, "chunk_id").select("entity_id", F.col("survivor").alias("chunk_id")).distinct()
        self.graph = self.graph.with_(chunks=settle(kept), next_chunk=settle(chain), from_chunk=settle(held))
        report = dedup.merge_report(before, self.graph.chunks, self.graph.next_chunk).first().asDict()
        if not report["success"]:
            raise ValueError(f"chunks were not merged: {report}")
        return report

    def _entity_merge(self) -> dict:
        key = self.settings.exact_match_property
        same = settle(resolve.canonical_ids(self.graph.entities, ["label", key]))
        entities, relations = resolve.resolve_exact(self.graph.entities, self.graph.relations, ["label", key])
        held = self.graph.from_chunk.join(same, "entity_id").select(F.col("canonical").alias("entity_id"), "chunk_id").distinct()
        members = self.graph.entities.where(F.col("label") == "mp_Attribution")
        masters = settle(resolve.component_masters(self.graph.similar, members))
        self.graph = self.graph.with_(entities=settle(entities), relations=settle(relations), from_chunk=settle(held), masters=masters)
        return resolve.master_stats(masters).first().asDict()

    def _pagerank(self) -> dict:
        nodes = self.graph.entities.select(F.col("entity_id").alias("id"), "label")
        found, counts = None, {}
        for view in VIEWS:
            labels = self.frames["view_projection_node"].where(F.col("view") == view)
            types = self.frames["view_projection_rel"].where(F.col("view") == view)
            own, edges = project(nodes, self.graph.relations, labels, types)
            counts[view] = own.count()
            ranked = centrality(own, edges, max_exact=self.settings.max_exact_nodes).select(F.lit(view).alias("view"), F.col("id").alias("entity_id"), "degree", "pagerank", "betweenness", "closeness", "combined")
            found = ranked if found is None else found.unionByName(ranked)
        self.graph = self.graph.with_(centrality=settle(found))
        return counts

    def _metapath(self) -> dict:
        g = self.graph
        cleared = g.metapaths.count()
        nodes, edges = g.entities.select(F.col("entity_id").alias("id"), "label", "name"), g.relations.select("rel_id", "src", "dst", "rel_type")
        paths.preflight(paths.template_counts(self.frames["path_template"], edges, nodes.select("id", "label")), g.centrality)
        ranks = settle(paths.best_rank(g.centrality))
        low = settle(paths.low_paths(edges, nodes, self.frames["path_template"], ranks))
        mid = settle(paths.mid_paths(self._groups(nodes, edges), ranks))
        links = settle(paths.link_paths(mid, low, g.from_chunk))
        counts = paths.check_paths(low, mid, links, require_mid=False)
        none = {"query": F.lit(None).cast("string"), "embedding": F.lit(None).cast("array<float>")}
        rows = _shaped(g.metapaths, low.withColumn("path_level", F.lit("low"))).unionByName(_shaped(g.metapaths, mid.withColumn("path_level", F.lit("mid")))).withColumns(none)
        rows = paths.path_embeddings(paths.path_sentences(rows, self.ask_sentence), self.embed)
        rows = settle(rows)
        self.graph = g.with_(metapaths=rows, path_hierarchy=links)
        self.postings = settle(retrieval.keyword_postings(rows.select("mp_id", F.concat_ws(" ", "query", "text").alias("text")), id="mp_id"))
        return counts | {"cleared": cleared, "embeddings_written": rows.where("embedding is not null").count()}

    def search_paths(self, words: list[str], k: int = 10):
        """mp_id (as id), hits, tf of the k paths with most of the words."""
        if self.postings is None:
            raise ValueError("the stage metapath has not run")
        return retrieval.keyword_search(self.postings, words, k)

    def nearest_paths(self, vector: list[float], k: int = 3):
        """rank, id, score of the k paths whose embedding is nearest to a vector."""
        asked = self.spark.createDataFrame([("", vector)], "id string, embedding array<float>")
        rows = self.graph.metapaths.select(F.col("mp_id").alias("id"), "embedding")
        return retrieval.nearest_by_cosine(rows, asked, k).drop("query_id")

    def _groups(self, nodes, edges):
        """Anchors and members: steps of a plan, members of a container."""
        label = lambda k: nodes.select(F.col("id").alias(f"{k}_id"), F.col("label").alias(f"{k}_label"), F.col("name").alias(f"{k}_name"))
        steps = edges.where("rel_type = 'p_plan_isStepOfPlan'").select(F.lit(0).alias("kind"), F.col("dst").alias("anchor_id"), F.col("src").alias("member_id"))
        members = edges.where("rel_type = 'prov_hadMember'").select(F.lit(1).alias("kind"), F.col("src").alias("anchor_id"), F.col("dst").alias("member_id"))
        both = steps.unionByName(members).join(label("anchor"), "anchor_id").join(label("member"), "member_id")
        both = both.where(((F.col("kind") == 0) & F.col("anchor_label").isin(PLAN_LABELS)) | ((F.col("kind") == 1) & F.col("anchor_label").isin(CONTAINER_LABELS)))
        by_label = self.frames["view_mapping"].select("view", F.col("label").alias("anchor_label"))
        return both.join(F.broadcast(by_label), "anchor_label").select("view", "kind", "anchor_id", "anchor_name", "member_id", "member_name")


def _shaped(like, df):
    """df with the columns of `like`, null where it has none."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema.fields])
