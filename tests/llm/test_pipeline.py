"""The corpus pipeline, stage by stage."""

import sys
from pathlib import Path

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from loomgraph.llm.registry import ORACLES, QUERIES
from loomgraph.storage import settle

sys.path.insert(0, str(Path(__file__).parent))
from test_pairs import components, shingle_set  # noqa: E402
from test_rows import base_spans  # noqa: E402

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        made = settle(stage(spark, docs, SMALL))
        out.append((name, docs, made))
        docs = made
    return {name: (before, after) for name, before, after in out}


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "token_ids"]
    for name, (before, after) in stages.items():
        assert name == "token_ids" or after.dtypes == before.dtypes


def test_quality_keeps_clean_documents(stages):
    labels = pq.read_table(f"{SMALL}/labels.parquet").to_pydict()
    kept = {r["doc_id"] for r in stages["quality"][1].select("doc_id").collect()}
    clean = [d for d, q, t in zip(labels["doc_id"], labels["quality"], labels["toxic"]) if q == 1 and t == 0]
    bad = [d for d, q, t in zip(labels["doc_id"], labels["quality"], labels["toxic"]) if q == 0 or t == 1]
    assert sum(d in kept for d in clean) >= 0.97 * len(clean) and sum(d in kept for d in bad) <= 0.35 * len(bad)


def test_each_stage_does_its_work(stages):
    before, after = stages["near_duplicates"]
    whole = components([(r["doc_id"], r["text"]) for r in before.collect()])
    assert {r["doc_id"] for r in after.select("doc_id").collect()} == {d for d, (_, c) in whole.items() if d == c}
    before, after = stages["decontamination"]
    items = [shingle_set(t) for t in pq.read_table(f"{SMALL}/benchmark.parquet")["text"].to_pylist()]
    clean = {r["doc_id"] for r in before.collect() if not any(4 * len(i & shingle_set(r["text"].lower())) >= 3 * len(i) for i in items)}
    assert {r["doc_id"] for r in after.select("doc_id").collect()} == clean
    before, after = stages["personal_data"]
    assert before.count() == after.count() and not any(base_spans(r["text"]) for r in after.collect())
    before, after = stages["token_ids"]
    assert after.count() == before.count() and after.where("n_tokens <> size(ids)").count() == 0


def test_run_gives_the_last_stage(spark, stages):
    got = sorted((r["doc_id"], r["n_tokens"]) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert got == sorted((r["doc_id"], r["n_tokens"]) for r in stages["token_ids"][1].collect())


def test_registry_has_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11)) and set(ORACLES) <= set(QUERIES)
