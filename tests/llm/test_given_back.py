"""What a worker process remembers for one operator goes when another one's task begins there."""

import weakref

import pyarrow as pa
import pytest

from loomgraph.llm import bpe, kernel, quality


@pytest.mark.parametrize("begin", [lambda: list(quality._counter(False)(iter([]))), lambda: kernel.tidied(lambda table: table)(pa.table({}))])
def test_the_tokenizer_is_given_back(begin):
    with open(bpe.vocabulary_path(), "rb") as f:
        blob = f.read()
    merges = bpe.load(blob)
    merges.encode(["words that no other task asks for"])
    assert bpe.load(blob) is merges
    held = weakref.ref(merges)
    del merges
    begin()
    assert held() is None
    assert bpe.load(blob).words == {}


def test_a_task_leaves_no_words_behind(spark):
    with open(bpe.vocabulary_path(), "rb") as f:
        blob = f.read()
    bpe.encode(spark.createDataFrame([("some words of a text",)] * 64, "text string").repartition(16)).collect()

    def left(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(bpe.load(blob).words)]})

    assert {r["n"] for r in spark.range(0, 16, 1, 16).mapInArrow(left, "n long").collect()} == {0}
