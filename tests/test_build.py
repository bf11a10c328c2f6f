import json
import threading

import pytest

from loomgraph.model import KnowledgeGraph
from loomgraph.ontology import Ontology, default_ontology, problems
from loomgraph.operators import extraction
from loomgraph.plans.pipeline import STAGES, Build, plan_stages
from loomgraph.sources import markdown, tables
from loomgraph.sources.config import Settings, load_settings, substitute
from loomgraph.sources.ontology_files import load_ontology
from loomgraph.streaming.events import EVENTS, StateFold, latest_by, run_states


@pytest.fixture
def folder(tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "b.md").write_text("# Results of B\nThe claim A1 is supported by D1 strongly.\n", encoding="utf-8")
    (docs / "a.md").write_text("# Abstract\nData D1 shows A1.\n" + "x" * 210 + "\n# Methods\nStep S1 of plan P1 used M1.\n", encoding="utf-8")
    (docs / "note.txt").write_text("no")
    (docs / "a_metadata.json").write_text(json.dumps({"dc_title": "Paper A", "dc_author": "N", "dc_publisher": "J", "dc_language": "en"}))
    (docs / "b_metadata.json").write_text(json.dumps({"dc_title": "Paper B"}))
    return docs


def test_markdown_and_sidecars(spark, folder, tmp_path):
    docs = markdown.read_markdown(spark, str(folder))
    assert [r["filename"] for r in markdown.list_documents(spark, str(folder)).collect()] == ["a.md", "b.md"]
    assert markdown.read_markdown(spark, str(tmp_path / "none")).count() == 0
    full = {r["filename"]: r for r in markdown.with_metadata(docs, markdown.read_sidecars(spark, str(folder))).collect()}
    assert full["a.md"]["dc_title"] == "Paper A" and full["a.md"]["dc_type"] is None
    assert full["b.md"]["dc_title"] == "b" and full["b.md"]["dcterms_identifier"] == "local:b.md" and full["b.md"]["dc_type"] == "Research Article"
    assert markdown.effective_count(docs, 1) == 1 and markdown.effective_count(docs, 0) == 2 and markdown.effective_count(docs, True) == 2
    assert [r["filename"] for r in markdown.select_documents(docs, ["b.md", "zz"], 1).collect()] == ["b.md"]
    assert [r["filename"] for r in markdown.select_documents(docs, None, 1).collect()] == ["a.md"]


def make_extractor():
    def extractor(text, triple):
        subject, relation, obj = triple
        if triple == ("whu_DataSet", "mp_supports", "mp_Claim"):
            props = lambda n: {"WHU_HASNAME": n}
            return json.dumps({"nodes": [{"id": "1", "label": subject, "properties": props("D1")}, {"id": "2", "label": obj, "properties": props("A1")}, {"id": "3", "label": "strange", "properties": {}}], "relationships": [{"type": relation, "start_node_id": "1", "end_node_id": "2", "properties": {}}, {"type": relation, "start_node_id": "2", "end_node_id": "1", "properties": {}}, {"type": relation, "start_node_id": "1", "end_node_id": "3", "properties": {}}]})
        if triple == ("whu_SupportGraph", "prov_hadMember", "mp_Claim"):
            return json.dumps({"nodes": [{"id": "g", "label": subject, "properties": {"WHU_HASNAME": "A1"}}, {"id": "c", "label": obj, "properties": {"WHU_HASNAME": "A1"}}], "relationships": [{"type": relation, "start_node_id": "g", "end_node_id": "c", "properties": {}}]})
        if relation == "whu_fellow":
            raise RuntimeError("model is down")
        return "not json"

    return extractor


def test_the_whole_build(spark, folder, tmp_path):
    heard = []
    build = Build(spark, Settings(data_dir=str(folder)), extractor=make_extractor(), listeners=[heard.append])
    summary = build.run(run_id="r1")
    g = build.graph
    assert summary["documents"] == 2 and summary["failed_docs"] == 0 and summary["stages_failed"] == []
    assert summary["stages_run"] == ["build_kg", "subgraph_annotate", "chunk_merge", "pagerank", "metapath"]
    assert {r["label"] for r in g.entities.select("label").collect()} == {"whu_DataSet", "mp_Claim", "whu_SupportGraph"}
    assert g.relations.where("rel_type = 'mp_supports'").count() == g.entities.where("label = 'whu_DataSet'").count()
    assert g.entities.where("llm_weight is null or dc_title is null").count() == 0
    assert g.relations.where("original_text is null or llm_weight is null").count() == 0
    assert g.metapaths.where("query is null or embedding is null or max_pagerank is null").count() == 0
    assert g.metapaths.select("path_level").distinct().count() == 2 and g.path_hierarchy.count() > 0
    assert heard == build.events and heard[-1]["type"] == "complete"
    state = run_states(build.events_frame()).first()
    assert state["current_stage"] is None and state["progress_index"] == state["progress_total"] == 5
    g.save(str(tmp_path / "graph"))
    assert KnowledgeGraph.load(spark, str(tmp_path / "graph")).stats().first() == g.stats().first()
    # on its own, a merge that the settings leave off still runs
    before = g.entities.count()
    assert build.run(only=["entity_merge"])["stages_run"] == ["entity_merge"]
    assert build.graph.entities.count() <= before
    assert build.run(only=["clear"])["nodes"] == 0


def test_stage_plans():
    assert plan_stages() == ["build_kg", "subgraph_annotate", "chunk_merge", "pagerank", "metapath"]
    assert plan_stages({"pagerank": False, "unheard": True}, skip=["metapath"]) == ["build_kg", "subgraph_annotate", "chunk_merge"]
    assert plan_stages({"entity_merge": False}, only=["metapath", "entity_merge"]) == ["entity_merge", "metapath"]
    assert plan_stages(dict.fromkeys(STAGES, True)) == STAGES
    with pytest.raises(ValueError):
        plan_stages(only=["nothing"])


def test_failures_stop_a_build(spark, tmp_path):
    build = Build(spark, Settings(data_dir=str(tmp_path)))
    with pytest.raises(ValueError):
        build.run()
    assert [e["type"] for e in build.events] == ["stage_start", "stage_done", "stage_start", "error"]


def test_cancelling_and_single_flight(spark, tmp_path):
    build = Build(spark, Settings(data_dir=str(tmp_path)))
    seen = []

    def listener(event):
        if event["type"] == "stage_start":
            build.cancel()
            with pytest.raises(RuntimeError):
                build.run()
            seen.append(threading.current_thread().name)

    build.listeners.append(listener)
    summary = build.run(only=["clear", "build_kg"])
    assert summary["stages_run"] == ["clear"] and build.events[-1]["type"] == "cancelled" and seen


def test_routing_by_section(spark):
    chunks = spark.createDataFrame([("f", 2, "Results", "r"), ("f", 1, "Abstract", "a"), ("g", 1, "Other", "o"), ("g", 2, "Results", " ")], "filename string, index int, section_role string, text string")
    templates = spark.createDataFrame([(1, ["results"]), (2, ["ALL"]), (3, []), (4, ["Experiment"]), (5, None)], "template_id int, sections array<string>")
    got = {(r["filename"], r["template_id"]): r["joined"] for r in extraction.route(chunks, templates).collect()}
    assert got == {("f", 1): "r", **{("f", k): "a\n\nr" for k in (2, 3, 5)}, **{("g", k): "o" for k in (2, 3, 5)}}


def test_extractor_errors_are_kept_apart(spark):
    routed = spark.createDataFrame([("f", 1, "x"), ("f", 2, "x")], "filename string, template_id int, joined string")
    templates = spark.createDataFrame([(1, "A", "r", "B"), (2, "A", "s", "B")], "template_id int, subject string, relation string, object string")

    def call(text, triple):
        if triple[1] == "s":
            raise ValueError("no")
        return "{}"

    got = {r["template_id"]: (r["output"], r["error"]) for r in extraction.extract(routed, templates, call, retries=1).collect()}
    assert got == {1: ("{}", None), 2: (None, "ValueError: no")}


def test_ontology_is_sound():
    o = default_ontology()
    found = problems(o)
    assert (len(o.entities), len(o.relations), len(o.triples), len(o.paths)) == (26, 21, 76, 68)
    assert found["errors"] == [] and len(found["warnings"]) == 2
    broken = Ontology({}, [], [("x", "y", "z", [], "low")], [], {"MPU": ["q", "q"]}, {})
    said = " ".join(problems(broken)["errors"])
    assert all(x in said for x in ("no entity", "x is not defined", "views are", "twice", "no Other"))


def test_ontology_files(spark, tmp_path):
    parts = {"entities.json": [{"label": "A", "properties": [{"name": "p", "type": "FLOAT"}]}, {"label": "B"}], "relations.json": [{"label": "r"}], "triples.json": [["A", "r", "B", ["All"], "low"]], "views.json": {"MPU": ["A"], "EBM": ["B"], "EEM": ["A"]}, "sections.json": {"mappings": {"Other": {"doco_deo_type": None, "roles": []}}}, "paths.json": {"MPU": [["A", "r", "B"]], "rank": "x"}}
    for name, value in parts.items():
        (tmp_path / name).write_text(json.dumps(value))
    o = load_ontology(spark, str(tmp_path), default_ontology())
    assert o.entities["A"] == {"p": "FLOAT"} and o.triples == [("A", "r", "B", ["All"], "low")] and o.paths == [("MPU", "A", "r", "B")]
    for name in ("entities.json", "sections.json"):
        (tmp_path / name).write_text("[]" if name == "entities.json" else "{}")
        with pytest.raises(ValueError):
            load_ontology(spark, str(tmp_path), default_ontology(), **({"entities": None} if name != "entities.json" else {}))


def test_settings(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"data_dir": "${HOME_DIR}/x", "stages": {"pagerank": False}, "ignored": 1}))
    s = load_settings(str(path), {"HOME_DIR": "/h", "LOOMGRAPH_MAX_DOCS": "3", "LOOMGRAPH_DATA_DIR": "/other"}, chunk_size=5)
    assert (s.data_dir, s.max_docs, s.stages, s.chunk_size) == ("/h/x", 3, {"pagerank": False}, 5)
    assert substitute({"a": ["${X}", "${NOT_SET}"]}, {"X": "1"}) == {"a": ["1", "${NOT_SET}"]}


def test_upserts_and_logs(spark, tmp_path):
    old = spark.createDataFrame([("a", 1, "x"), (None, 2, "y")], "k string, v int, w string")
    new = spark.createDataFrame([("a", 9, None), ("b", 3, "z"), (None, 4, "q")], "k string, v int, w string")
    assert sorted(map(str, tables.upsert(old, new, ["k"]).collect())) == sorted(map(str, new.collect()))
    assert ("a", 9, "x") in [tuple(r) for r in tables.upsert(old, new, ["k"], fill=True).collect()]
    assert tables.delete(old, new.where("k = 'a'"), ["k"]).count() == 1
    events = spark.createDataFrame([(2, "b"), (1, "a")], "seq long, type string")
    tables.write_log(events, str(tmp_path / "log"), {"run": 1}, {"ok": True})
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "log")).collect()]
    assert lines == ['{"run": 1}', '{"type":"a"}', '{"type":"b"}', "=== END ===", '{"ok": true}']


ROWS = [("r1", 1, "stage_start", "s1", 1, 2, None), ("r1", 2, "stage_done", "s1", 1, 2, None), ("r1", 3, "stage_start", "s2", 2, 2, None), ("r2", 1, "stage_start", "s1", 1, 1, None), ("r1", 4, "error", "s2", None, None, "broke"), ("r2", 2, "log", None, None, None, "x")]


def test_run_states(spark):
    got = {r["run_id"]: (r["current_stage"], r["progress_index"], r["last_error"], r["last_seq"]) for r in run_states(spark.createDataFrame(ROWS, EVENTS)).collect()}
    assert got == {"r1": (None, 2, "broke", 4), "r2": ("s1", 1, None, 2)}
    assert latest_by(spark.createDataFrame(ROWS, EVENTS), "run_id", ["seq"], ["type"]).count() == 2


def test_streamed_states_equal_the_batch(spark, tmp_path):
    for k, rows in enumerate((ROWS[3:], ROWS[:3])):  # late events come second
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        assert k < 2
    fold = StateFold()
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    fold.start(stream, str(tmp_path / "check")).awaitTermination()
    want = sorted(map(str, run_states(spark.createDataFrame(ROWS, EVENTS)).collect()))
    assert sorted(map(str, fold.states.collect())) == want
    fold.add(spark.createDataFrame(ROWS[:2], EVENTS), 99)  # a repeated batch
    assert sorted(map(str, fold.states.collect())) == want


def test_the_rest_works_without_the_optional_parts(spark, tmp_path):
    """A copy without the training-data folders still imports and has the graph queries."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "loomgraph", tmp_path / "loomgraph", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'chunk_split' in q and not any(n.startswith('op') for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin:/usr/local/bin"}, timeout=120)
