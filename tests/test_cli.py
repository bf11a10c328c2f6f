"""The build as the README runs it, and what the settings name."""

import json

import pytest
from test_build import folder  # noqa: F401

from loomgraph.cli import main
from loomgraph.model import KnowledgeGraph
from loomgraph.ontology import default_ontology
from loomgraph.operators import chunking, extraction
from loomgraph.plans.pipeline import Build
from loomgraph.sources.config import Settings, callable_named


def test_the_command_of_the_readme_ends_well(spark, folder, tmp_path, capsys):  # noqa: F811
    names = tmp_path / "names.json"
    names.write_text(json.dumps({"whu_DataSet": ["D1"], "mp_Claim": ["A1"], "mp_Statement": ["unheard"]}))
    config = tmp_path / "settings.json"
    config.write_text(json.dumps({"data_dir": str(folder), "dictionary": str(names)}))
    out = tmp_path / "graph"
    assert main(["--config", str(config), "--all", "--out", str(out), "--log", str(tmp_path / "log")]) == 0
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert summary["stages_failed"] == [] and summary["documents"] == 2 and summary["entities"] > 0
    graph = KnowledgeGraph.load(spark, str(out))
    assert graph.metapaths.count() > 0 and graph.relations.where("rel_type = 'mp_supports'").count() > 0
    assert spark.read.parquet(f"{out}/path_postings").where("token = 'd1'").count() > 0
    lines = [r[0] for r in spark.read.text(str(tmp_path / "log")).collect()]
    assert "=== END ===" in lines and len(lines) > 5
    with pytest.raises(SystemExit):
        main(["--config", str(config)])


def test_search_and_back_fill(spark, folder):  # noqa: F811
    text = "before The claim A1 is supported by D1 strongly. after"
    stored = spark.createDataFrame([("old", None, text)], "chunk_id string, filename string, text string")
    build = Build(spark, Settings(data_dir=str(folder)), extractor=extraction.dictionary_extractor({"whu_DataSet": ["D1"], "mp_Claim": ["A1"]}))
    empty = build.graph.chunks
    build.graph = build.graph.with_(chunks=stored.unionByName(empty, allowMissingColumns=True).select(*empty.columns))
    build.run(only=["build_kg"], flags={"pagerank": False})
    # the preview of b.md's chunk begins with its heading, which the stored text lacks
    assert build.results["build_kg"]["backfilled"] == 0 and build.graph.chunks.where("chunk_id = 'old'").count() == 1
    held = stored.selectExpr("chunk_id", "filename", "concat('x ', '# Results of B\\nThe claim A1 is supported by D1 strongly.') as text")
    build.graph = build.graph.with_(chunks=held.unionByName(empty, allowMissingColumns=True).select(*empty.columns))
    build.run()
    assert build.results["build_kg"]["backfilled"] == 1
    assert build.graph.chunks.where("chunk_id = 'old'").first()["filename"] == "b.md"
    assert build.search_paths(["D1", "A1"]).first()["hits"] == 2
    one = build.graph.metapaths.select("mp_id", "embedding").first()
    assert build.nearest_paths(list(one["embedding"])).first()["score"] == pytest.approx(1)


def test_chunks_are_cut_where_the_meaning_changes(spark):
    rows = [("a", 0, "The river is wide. The river is cold. A price rose. It fell again.", "h"), ("a", 2, "no stop", "i"), ("b", 0, "", "j")]
    got = chunking.resplit(spark.createDataFrame(rows, "filename string, chunk_id int, chunk string, header_path string"), lambda texts: [[1.0, 0.0] if "river" in t else [0.0, 1.0] for t in texts], threshold=0.5)
    assert sorted(tuple(r) for r in got.collect()) == [("a", 0, "The river is wide. The river is cold.", "h"), ("a", 1, "A price rose. It fell again.", "h"), ("a", 2, "no stop", "i"), ("b", 0, "", "j")]


def test_what_settings_name(spark, tmp_path):
    assert callable_named(None) is None and callable_named("json:dumps") is json.dumps
    with pytest.raises(ValueError):
        callable_named("json")
    (tmp_path / "views.json").write_text(json.dumps({v: ["one"] for v in ("MPU", "EBM", "EEM")}))
    (tmp_path / "entities.json").write_text(json.dumps([{"label": "one", "properties": []}]))
    build = Build.from_settings(spark, Settings(schema_dir=str(tmp_path), extractor="json:dumps", embed="math:sqrt"))
    assert set(build.ontology.entities) == {"one"} and build.ontology.triples == default_ontology().triples
    assert build.extractor is json.dumps and Build.from_settings(spark, Settings(), extractor=print).extractor is print


def test_only_transient_errors_are_repeated(spark, tmp_path):
    log = str(tmp_path / "calls")

    def call(text, triple):
        with open(log, "a") as f:
            f.write("x")
        raise (TimeoutError if triple[1] == "slow" else KeyError)(triple[1])

    templates = spark.createDataFrame([(1, "s", "slow", "o"), (2, "s", "bad", "o")], "template_id int, subject string, relation string, object string")
    routed = spark.createDataFrame([("a.md", 1, "t"), ("a.md", 2, "t")], "filename string, template_id int, joined string")
    got = {r["template_id"]: r["error"] for r in extraction.extract(routed, templates, call, retries=2, transient=(TimeoutError,)).collect()}
    assert got == {1: "TimeoutError: slow", 2: "KeyError: 'bad'"}
    with open(log) as f:
        assert len(f.read()) == 4
