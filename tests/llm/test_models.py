"""Language-model scores and nearest neighbours against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from loomgraph.llm import neighbours, ngram_lm

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def scores(rows, m=ngram_lm.MASS):
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + [None] for _, t in rows]
    c, pairs, triples = Counter(), Counter(), Counter()
    for h, ws in zip(held, tokens):
        if not h:
            c.update(ws)
            c["<s>"] += 1
            pairs.update(zip(["<s>", *ws], ws))
            triples.update(zip(["<s>", *ws], ws, ws[1:]))
    starts = c.pop("<s>", 0)
    n, v = sum(c.values()), len(c)
    uni = lambda w: (c[w] + 0.5) / (n + 0.5 * (v + 1))
    two = lambda a, w: (pairs[a, w] + m * uni(w)) / ((starts if a == "<s>" else c[a]) + m)
    three = lambda a, b, w: (triples[a, b, w] + m * two(b, w)) / (pairs[a, b] + m)
    whole = lambda ws: math.log10(two("<s>", ws[0])) + sum(math.log10(three(a, b, w)) for a, b, w in zip(["<s>", *ws], ws, ws[1:]))
    return [(h, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10(uni(w)) for w in ws), whole(ws)) for h, ws in zip(held, tokens)]


def hold(got, want):
    assert tuple(got)[1:5] == want[:4]
    assert got["base_score"] == pytest.approx(want[4], abs=1e-9)
    assert got["score"] == pytest.approx(want[5], rel=0.01, abs=1e-9)


def test_op5_equals_brute_force(spark):
    t = pq.read_table(f"{SMALL}/documents.parquet").to_pydict()
    rows = list(zip(t["doc_id"], t["text"]))
    got = {r["doc_id"]: r for r in ngram_lm.op5_ngram_score(spark, SMALL).collect()}
    want = scores(rows)
    for (d, _), w in zip(rows, want):
        hold(got[d], w)
    outside = [(got[d], w) for (d, _), w in zip(rows, want) if w[0]]
    assert sum(g["score"] for g, _ in outside) > 1.05 * sum(g["base_score"] for g, _ in outside)
    assert sum(g["score"] for g, _ in outside) == pytest.approx(sum(w[5] for _, w in outside), rel=0.01)


def test_scores_of_odd_rows(spark):
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choice("aBcDeé") for _ in range(rng.randint(0, 30)))) for k in range(80)] + [(None, "a b"), (None, None), (200, ""), (201, "zz " * 9000), (202, " \t"), (1, "same id")]
    frame = spark.createDataFrame([(*r, 0, b"x") for r in rows], "doc_id long, text string, block int, facts binary")
    got = sorted(ngram_lm.score(frame).collect(), key=lambda r: (str(r["doc_id"]), r["n_tokens"], r["base_score"]))
    want = sorted(zip(rows, scores(rows)), key=lambda x: (str(x[0][0]), x[1][1], x[1][4]))
    assert len(got) == len(want)
    for g, (_, w) in zip(got, want):
        hold(g, w)
    assert ngram_lm.score(frame.where("false")).count() == 0
    held = [k for k in range(100) if zlib.crc32(str(k).encode()) % 5 == 1][:3]
    only = ngram_lm.score(spark.createDataFrame([(k, "a b") for k in held], "doc_id long, text string")).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in only)


@pytest.mark.parametrize("n, top", [(0, 5), (1, 5), (1, 2**63), (50_000, 2**63), (40_000, 100), (100_000, 10**9)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
    coded = ngram_lm.EliasFano(values, lambda x: x)
    wanted = np.sort(np.concatenate([values[rng.integers(0, n, 200)] if n else values, rng.integers(0, top, 200, dtype=np.uint64)]))
    place, equal = coded.successor(wanted)
    assert (place == np.searchsorted(values, wanted)).all() and (equal == np.isin(wanted, values)).all()
    places = np.sort(rng.integers(0, n, 500)) if n else np.zeros(0, np.int64)
    assert (coded.at(places) == values[places]).all()
    bits = 8 * (coded.bits.nbytes + coded.lows.nbytes)
    assert n < 1000 or bits <= n * (math.log2(top / n + 1) + 11)


def test_trie_finds_the_counts_of_each_context():
    rng = np.random.default_rng(2)
    pairs = sorted({(int(c), int(w)) for c, w in zip(rng.integers(0, 300, 5000), rng.integers(0, 2**63, 200)[rng.integers(0, 200, 5000)])} | {(2**63, 2**64 - 1), (2**63, 0)})
    context, successor = (np.array(x, np.uint64) for x in zip(*pairs))
    count = rng.integers(1, 10_000, len(pairs))
    trie = ngram_lm.Trie(context, successor, count)
    other = [(int(c), int(w) ^ int(f)) for c, w, f in zip(context, successor, rng.integers(0, 2, len(pairs)))] + [(301, 7), (2**64 - 1, 5), (0, 1)]
    asked = sorted(set(other) | set(pairs))
    got = trie.lookup(*(np.array(x, np.uint64) for x in zip(*asked)))
    known = dict(zip(pairs, count.tolist()))
    assert ngram_lm.frequencies(got) == pytest.approx([known.get(x, 0) for x in asked], rel=3e-4)
    none = ngram_lm.Trie(*(np.zeros(0, np.uint64),) * 2, np.zeros(0, np.int64))
    assert none.lookup(context, successor).tolist() == [0] * len(pairs)
    trie.close()
    none.close()


def test_quantised_counts():
    counts = np.array([0, 1, 5000, 2**20 - 1, 2**20, 3 * 10**6, 10**14])
    codes = ngram_lm.quantised(counts)
    got = ngram_lm.frequencies(codes)
    assert got[:5].tolist() == counts[:5].tolist() and got == pytest.approx(counts, rel=2e-6) and codes.max() < 1 << 25


@pytest.mark.parametrize("part_tokens", [1, 10**6])
def test_scores_are_the_same_however_many_parts(spark, part_tokens):
    """After known and unseen contexts, with known words, the end and an unknown word."""
    train = [(0, "a b c a b d"), (1, "b a a")]
    held = [k for k in range(4000) if zlib.crc32(str(k).encode()) % 5 == 1]
    starts = ["", "a", "a b", "c a", "zz", "zz a"]
    texts = [f"{s} {w}".strip() for s in starts for w in ("a", "b", "c", "d", "zz", "")]
    rows = train + list(zip(held, dict.fromkeys(texts)))
    got = {r["doc_id"]: r["score"] for r in ngram_lm.score(spark.createDataFrame(rows, "doc_id long, text string"), part_tokens=part_tokens).collect()}
    assert [got[d] for d, _ in rows] == pytest.approx([w[5] for w in scores(rows)], rel=1e-9)


def test_messages_are_no_more_than_ngrams(spark, monkeypatch):
    """Only messages with contents are sent, however many parts there are."""
    sent = {}
    for blocks in (4, 16):
        rows = [(k, " ".join(f"w{(k * 7 + j * j) % 50}" for j in range(20))) for k in range(blocks * 10)]
        made = list(_blocks(spark, rows, 400))
        for parts in ((3, 3), (400, 400)):
            out = [b for r in made for b in ngram_lm._asking(parts, (24, 16))([r])]
            sent[blocks, parts[0]] = sum(b.num_rows for b in out)
            asked = sum(len(b.keys) + len(b.vocabulary) for b in (ngram_lm.Block(r.to_pylist()[0], parts, (24, 16)) for r in made))
            assert sent[blocks, parts[0]] <= min(asked, len(made) * parts[0] * parts[1])
    assert sent[16, 400] <= 5 * sent[4, 400]


def _blocks(spark, rows, size):
    import pyarrow as pa

    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    kept = frame.mapInArrow(lambda batches: ngram_lm._coded(batches, size), ngram_lm._BLOCKS_SQL).collect()
    for r in kept:
        yield pa.RecordBatch.from_pylist([{k: bytes(v) if isinstance(v, bytearray) else v for k, v in r.asDict().items()}], schema=ngram_lm._BLOCKS)


def exact(ids, vectors, queries, k=20):
    out = {}
    for q in queries:
        s = vectors @ vectors[ids.index(q)]
        out[q] = [ids[j] for j in sorted(range(len(ids)), key=lambda j: (-round(s[j], 12), ids[j])) if ids[j] != q][:k]
    return out


def test_op8_recall_and_scores(spark):
    t = pq.read_table(f"{SMALL}/embeddings.parquet").to_pydict()
    vectors = np.array(t["embedding"], float)
    want = exact(t["vec_id"], vectors, [v for v in t["vec_id"] if v % 20 == 0])
    got = {}
    for r in neighbours.op8_hash_prefix_forest(spark, SMALL).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["rank"] == len(got[r["query_id"]])
        assert r["score"] == pytest.approx(float(vectors[t["vec_id"].index(r["query_id"])] @ vectors[t["vec_id"].index(r["vec_id"])]), abs=1e-12)
    assert got.keys() == want.keys()
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.9


def test_ties_copies_and_blocks(spark):
    rng = np.random.default_rng(3)
    points = rng.standard_normal((300, 16))
    points[40:160] = points[0]  # one vector very often
    rows = [(k, v.tolist()) for k, v in enumerate(points)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(frame, frame.where("vec_id % 20 = 0"), block=70).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    want = exact(list(range(300)), points, range(0, 300, 20))
    assert got[0] == want[0] == list(range(40, 60))
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.9


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (8, [1.0, 1.0, 1.0]), (None, [1.0, 1.0]), (9, [2.0, 0.0]), (20, [1.0, 1.0, 0.0])]
    frame = spark.createDataFrame([(*r, 1, "q") for r in rows], "vec_id long, embedding array<double>, rank int, query_id string")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in neighbours.nearest(frame, frame).where("query_id in (0, 20, 4)").orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 9, 2.0), (0, 2, 1, 0.5), (20, 1, 8, 2.0)]
    assert neighbours.nearest(frame.where("false"), frame).count() == 0 and neighbours.nearest(frame, frame.where("false")).count() == 0
