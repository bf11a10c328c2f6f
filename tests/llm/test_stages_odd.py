"""Every pipeline stage on nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import pytest

import corpus_pipeline
from loomgraph.storage import settle

NAMES = ["_row", "_key", "_text", "_gone", "block", "weight", "part", "component_id", "class", "spans", "h", "good"]


@pytest.fixture
def folder(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 0, 1), (99, 0, None), (2, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def rows():
    long = " ".join(f"word{k}" for k in range(40_000))
    texts = [(1, "the plain first text of five words and more"), (None, None), (3, ""), (3, "   "), (None, "a null id"), (5, long), (6, "x alpha beta gamma delta epsilon zeta"), (7, "mail a@b.org"), (7, "mail a@b.org"), (None, None)]
    return [(d, t, None if k % 2 else "en", None, None, *range(len(NAMES))) for k, (d, t) in enumerate(texts)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in NAMES)


def test_stages_on_odd_rows(spark, folder):
    docs = spark.createDataFrame(rows(), SCHEMA)
    left = {"quality": 10, "near_duplicates": 10, "decontamination": 9, "personal_data": 9, "token_ids": 9}
    for name, stage in corpus_pipeline.STAGES:
        made = settle(stage(spark, docs, folder))
        assert made.count() == left[name], name
        if name != "token_ids":
            assert made.dtypes == docs.dtypes
            assert all([r[n] for n in NAMES] == list(range(len(NAMES))) for r in made.select(*NAMES).collect())
        docs = made
    out = docs.collect()
    assert sorted(r["n_tokens"] for r in out)[:3] == [0, 0, 0] and max(r["n_tokens"] for r in out) > 40_000
    assert {r["doc_id"] for r in out} == {1, None, 3, 5, 7}


def test_stages_on_empty_tables(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, folder))
        assert docs.count() == 0, name
    empty = spark.createDataFrame(rows(), SCHEMA).select("doc_id", "text")
    assert corpus_pipeline.token_ids(spark, empty, folder).columns == ["doc_id", "n_tokens", "ids"]


def test_stages_without_labels_or_items(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows(), SCHEMA)
    assert corpus_pipeline.quality(spark, docs, str(tmp_path)).count() == 10
    assert corpus_pipeline.decontamination(spark, docs, str(tmp_path)).count() == 10
