"""Personal data in texts of very many matches, and rows whose columns have our names."""

import hashlib
import sys
import time
from pathlib import Path

import pytest

from loomgraph.llm import pii

sys.path.insert(0, str(Path(__file__).parent))
from test_rows import base_spans  # noqa: E402


def test_a_hundred_thousand_matches_take_seconds(spark):
    text = " ".join(f"u{k}@ex{k % 7}.org 10.0.{k % 256}.{k % 300}" for k in range(50_000))
    docs = spark.createDataFrame([(1, text), (2, "é " + text)], "doc_id long, text string")
    weights = {"ip|": 5.0}  # all near misses are judged to be real, so every list is long
    began = time.time()
    rows = {r["doc_id"]: r for r in pii.detect(docs, weights=weights).collect()}
    assert time.time() - began < 60
    want = base_spans(text)
    assert [(s["kind"], s["start"], s["end"]) for s in rows[1]["_base"]] == want and len(want) > 90_000
    assert [(s["kind"], s["start"], s["end"]) for s in rows[2]["_base"]] == [(k, a + 2, b + 2) for k, a, b in want]
    assert len(rows[1]["spans"]) == 100_000
    began = time.time()
    clean = pii.redact(docs.where("doc_id = 2"), weights=weights).first()["text"]
    assert time.time() - began < 60 and clean == "é " + " ".join(["[EMAIL] [IP]"] * 50_000)


def test_columns_of_any_name_stay(spark):
    names = ["_other", "_base", "_email", "_ip", "_card", "_phone", "_local", "_secret", "_row", "_text", "spans", "base", "other", "email"]
    docs = spark.createDataFrame([(1, "write a@b.org", *range(len(names)))], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    row = pii.detect(docs, weights={}).first().asDict()
    assert {n: row[n] for n in names if n not in ("_base", "_other", "spans")} == {n: k for k, n in enumerate(names) if n not in ("_base", "_other", "spans")}
    assert [(s["kind"], s["start"], s["end"]) for s in row["_base"]] == [("email", 6, 13)]
    kept = pii.redact(docs, weights={})
    assert kept.columns == docs.columns and kept.first()["text"] == "write [EMAIL]" and kept.first()["_other"] == 0


def test_empty_tables_and_null_texts(spark, tmp_path):
    schema = "doc_id long, text string"
    none = spark.createDataFrame([], schema)
    assert pii.detect(none).count() == 0 and pii.redact(none).count() == 0
    none.write.parquet(f"{tmp_path}/documents.parquet")
    assert pii.op4_pii(spark, str(tmp_path)).count() == 0
    rows = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "a@b.org"), (2, "a@b.org")], schema)
    got = pii.detect(rows).collect()
    assert sorted(len(r["spans"]) for r in got) == [0, 0, 0, 1, 1]


@pytest.mark.parametrize("text", ["", "a@b.org", "1.2.3.4 " * 40 + "+49 30 1234567 4111 1111 1111 1111", "x@y.z" * 9])
def test_base_digest_equals_brute_force(spark, tmp_path, text):
    spark.createDataFrame([(5, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    row = pii.op4_pii(spark, str(tmp_path)).first()
    want = base_spans(text)
    assert row["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
    assert row["n_spans"] == len([x for x in row["spans"].split(",") if x])
    assert row["spans"] == "" or set(f"{k}:{a}:{b}" for k, a, b in want) <= set(row["spans"].split(","))
