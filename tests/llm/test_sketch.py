"""The containment search goes through its sketches."""

import random

from pyspark.sql import functions as F

from loomgraph.llm import decontaminate


def tables(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choice(words) for _ in range(30))) for k in range(6)]
    docs = [(k, " ".join([*(rng.choice(words) for _ in range(40)), items[k % 6][1] if k % 2 else ""])) for k in range(24)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_nothing_is_found_without_the_sketch(spark, monkeypatch):
    docs, items = tables(spark)
    assert decontaminate.leaks(docs, items).count() == 12
    whole = decontaminate.sketches
    monkeypatch.setattr(decontaminate, "sketches", lambda own, threshold: whole(own, threshold).where("false"))
    assert decontaminate.leaks(docs, items).count() == 0


def test_a_sketch_is_the_smallest_hashes_and_the_search_joins_no_other(spark):
    docs, items = tables(spark)
    own = decontaminate.item_shingles(items, "item_id", "text", 5, 0.75)
    sketch = decontaminate.sketches(own, 0.75)
    whole = own.groupBy("item_id").agg(F.array_sort(F.collect_list("h")).alias("hs")).collect()
    held = {r["item_id"]: sorted(r["hs"]) for r in sketch.groupBy("item_id").agg(F.collect_list("h").alias("hs")).collect()}
    assert all(held[r["item_id"]] == r["hs"][: len(r["hs"]) - -(-3 * len(r["hs"]) // 4) + 1] for r in whole)
    # without an item's rows in the sketch, no pair of it is even a candidate
    found = decontaminate.search(docs, sketch.where("item_id = 1"))
    assert {r["item_id"] for r in found.collect()} == {1}


def test_rows_of_one_id_are_one_document(spark):
    item = " ".join(f"q{k}" for k in range(40))
    w = item.split()
    rows = [(1, " ".join(w[:20])), (1, " ".join(w[16:])), (None, " ".join(w[:20])), (None, " ".join(w[16:])), (2, " ".join(w[:20]))]
    found = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["shared"]) for r in found) == [("1", 36), ("None", 36)]
