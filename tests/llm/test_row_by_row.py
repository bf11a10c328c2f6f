"""Rows of one id, or of none, are kept and dropped one by one."""

from collections import Counter

import corpus_pipeline
from loomgraph.llm import jaccard_join


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_clean_rows_of_null_or_shared_id_outlive_copies(spark):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (None, "q r s"), (None, "only null one"), (None, "only null one"), (5, "u v w x y z"), (5, "five of its own"), (4, "u v w x y z"), (None, None), (None, "")]
    got = Counter(tuple(r) for r in jaccard_join.keep_one(frame(spark, rows)).collect())
    assert got == Counter([(7, "a b c d e f"), (None, "q r s"), (None, "only null one"), (None, "only null one"), (4, "u v w x y z"), (5, "five of its own"), (None, None), (None, "")])


def test_one_of_several_near_null_rows_stays(spark):
    text = " ".join(f"w{k}" for k in range(80))
    kept = jaccard_join.keep_one(frame(spark, [(None, text), (None, text + " end"), (None, text + " fin")])).collect()
    assert len(kept) == 1


def test_clean_rows_outlive_leaks_of_their_id(spark, tmp_path):
    frame(spark, [(1, "a b c d e f g")]).withColumnRenamed("doc_id", "item_id").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, "x a b c d e f g"), (None, "clean"), (None, None), (2, "clean text"), (3, "A B C D E F G"), (3, "clean too")]
    kept = corpus_pipeline.decontamination(spark, frame(spark, rows), str(tmp_path)).collect()
    assert Counter(tuple(r) for r in kept) == Counter([(None, "clean"), (None, None), (2, "clean text"), (3, "clean too")])
