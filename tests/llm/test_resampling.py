"""Importance resampling against a recount in plain Python, and words that a weak hash confuses."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from loomgraph.llm import jaccard_join, kernel, ngram_lm, quality, substring_dedup


def ngram_counts(text):
    words = [w.strip("!.,?").lower() for w in (text or "").split()]
    return Counter([*words, *zip(words, words[1:])])


def corpus():
    good = [(k, f"the Quiet river, the river bends north {'slowly' if k % 2 else 'now'}") for k in range(12)]
    bad = [(50 + k, "win cash now! win win cash" + " now" * k) for k in range(6)]
    rest = [(90, "the river sells cash"), (91, ""), (92, None), (None, "the river bends"), (93, "unheard words here"), (90, "the river sells cash")]
    docs = good + bad + rest
    labels = [(d, 1, 0) for d, _ in good[:8]] + [(d, 0, 0) for d, _ in bad[:4]]
    return docs, labels


def test_weights_keys_and_drawn_rows_equal_a_recount(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame([(*d, "x", 1.5) for d in docs], "doc_id long, text string, weight string, _draw double")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = frame.select("doc_id", "text", "weight")
    model = quality.fit(frame, marks, times=True)
    got = quality.importance(rows, model).collect()
    good = {d for d, q, t in labels if q and not t}
    raw, target = Counter(), Counter()
    for d, text in docs:
        raw.update(ngram_counts(text))
        if d in good:
            target.update(ngram_counts(text))
    share = sum(target.values()) / sum(raw.values())
    ratio = {g: math.log((target[g] + 1) / (raw[g] * share + 1)) for g in raw}
    assert any(x > 0.2 for x in ratio.values()) and any(x < -0.2 for x in ratio.values())
    for r in got:
        assert r["_importance"] == pytest.approx(sum(n * ratio[g] for g, n in ngram_counts(r["text"]).items()), abs=1e-4)
    # the draw: the keys less their weights are standard Gumbel noise of the row, and the largest keys win
    noise = {(r["doc_id"], r["text"]): r["_draw"] - r["_importance"] for r in got}
    assert len(noise) == len(docs) - 1 and abs(np.mean(list(noise.values())) - 0.5772) < 1
    size = 9
    want = sorted((r["_draw"] for r in got), reverse=True)[:size]
    drawn = quality.draw(frame, marks, size)
    assert drawn.columns == frame.columns
    again = {(r["doc_id"], r["text"]): r["_draw"] for r in got}
    assert Counter(again[r["doc_id"], r["text"]] for r in drawn.collect()) == Counter(x for x in (r["_draw"] for r in got) if x >= want[-1])
    assert quality.draw(frame, marks, 1000).count() == len(docs) and quality.draw(frame.where("false"), marks, 5).count() == 0


def test_noise_is_gumbel(spark):
    values = np.array([r[0] for r in spark.range(20_000).selectExpr("id as doc_id", "cast(id as string) as text").select(quality.gumbel("doc_id", "text")).collect()])
    assert abs(values.mean() - 0.5772) < 0.03 and abs(values.std() - math.pi / math.sqrt(6)) < 0.03
    assert abs((values < 0).mean() - math.exp(-1)) < 0.01


def test_op3_query_draws_the_share(spark):
    rows = quality.op3_quality_resample(spark, "/root/testdata/sf0.001").collect()
    keys = sorted((r["draw_key"] for r in rows), reverse=True)
    assert [bool(r["draws"]) for r in rows] == [r["draw_key"] >= keys[round(quality.SAMPLE * len(rows)) - 1] for r in rows]


def thue_morse(n):
    out = "a"
    while len(out) < n:
        out += out.translate(str.maketrans("ab", "ba"))
    return out, out.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [64, 256, 512, 1024, 4096])
def test_patterned_words_do_not_collide(n):
    hashes, bounds = kernel.words(*kernel.texts(pa.array(thue_morse(n))), True)
    assert len(set(hashes.tolist())) == 2 and bounds.tolist() == [0, 1, 2]


def test_patterned_words_are_neither_linked_nor_removed_nor_confused(spark):
    for n in (1024, 4096):
        a, b = thue_morse(n)
        docs = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
        assert {r["component_id"] for r in jaccard_join.near_components(docs).collect()} == {1, 2}
        run = " ".join(f"w{k}" for k in range(19))
        windows = spark.createDataFrame([(1, f"{run} {a}"), (2, f"{run} {b}")], "doc_id long, text string")
        assert [r["n_removed"] for r in substring_dedup.remove_repeats(windows).collect()] == [0, 0]
        known = {r["doc_id"]: r["n_known"] for r in ngram_lm.score(spark.createDataFrame([(0, a), (3, b)], "doc_id long, text string")).collect()}
        assert known == {0: 2, 3: 1}  # 3 is held out


def test_hashes_depend_on_bytes_alone():
    texts = ["ab abcdefgh abcdefghi", "x" * 255 + " " + "x" * 256 + " " + "x" * 257, "é Ü 日本"]
    data, offsets = kernel.texts(pa.array(texts))
    whole, bounds = kernel.words(data, offsets, False)
    for k, text in enumerate(texts):
        alone, _ = kernel.words(*kernel.texts(pa.array([" \t" + text + "  "])), False)
        assert alone.tolist() == whole[bounds[k] : bounds[k + 1]].tolist()
    assert len(set(whole.tolist())) == 9
    upper, _ = kernel.words(*kernel.texts(pa.array(["AB ab"])), True)
    assert upper[0] == upper[1]
    assert kernel.words(data, offsets, False, 1)[0].tolist() != whole.tolist()


def test_ngrams_of_a_batch_are_not_held_at_once():
    import tracemalloc

    texts = pa.array([f"Some words of {k} and {k * k} more, so that pieces end within the batch." * 9 for k in range(1500)])

    def found():
        for a, _, data, offsets in quality._pieces(texts):
            row, cell = quality.features(data, offsets)
            yield from zip((row + a).tolist()[:50], cell.tolist()[:50])

    tracemalloc.start()
    for _ in quality._pieces(texts):
        quality.features(_[2], _[3])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32_000_000, peak
    whole = set(zip(*(x.tolist() for x in quality.features(*quality.texts(texts)))))
    assert set(found()) <= whole and sum(b - a for a, b, *_ in quality._pieces(texts)) == len(texts)
