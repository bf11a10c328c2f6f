"""Signs of bad documents that few documents hold."""

import random

from loomgraph.llm import quality


def small_corpus():
    """60 good documents, and 12 toxic ones that each hold two of four slurs: 6 documents a slur."""
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "bcdfghjk" for b in ("ale", "oor", "ine", "uth", "eam")]
    text = lambda: [rng.choice(words) for _ in range(40)]
    good = [(k, " ".join(text())) for k in range(60)]
    slurs = ["moron", "scum", "clown", "trash"]
    toxic = [(100 + k, " ".join([*text(), slurs[k % 4], slurs[(k + 1) % 4]])) for k in range(12)]
    return good, toxic


def test_rare_toxic_words_weigh_in_a_small_corpus(spark):
    good, toxic = small_corpus()
    docs = spark.createDataFrame(good + toxic, "doc_id long, text string")
    labels = spark.createDataFrame([(d, 1, int(d >= 100)) for d, _ in good + toxic], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"] for r in quality.keep_good(docs, labels).collect()}
    assert kept == {d for d, _ in good}


def test_chance_is_fishers():
    assert abs(quality._chance(2, 0, 2, 2) - 1 / 6) < 1e-12
    assert abs(quality._chance(0, 3, 5, 7) - 1) < 1e-12
    assert abs(quality._chance(1, 1, 2, 2) - 5 / 6) < 1e-12
