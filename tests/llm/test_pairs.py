"""Near duplicates, repeated passages and leaks against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from loomgraph.llm import decontaminate, jaccard_join, substring_dedup
from loomgraph.llm.decontaminate import OP9_SQL
from loomgraph.llm.kernel import expand, pack, squeeze, unpack

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(rows):
    sets = {d: shingle_set(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    shared = Counter((a, b) for ds in holders.values() for i, a in enumerate(ds) for b in ds[:i])
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def rows_of(folder, name="documents", key="doc_id"):
    t = pq.read_table(f"{folder}/{name}.parquet").to_pydict()
    return list(zip(t[key], t["text"]))


def noisy_corpus(seed, groups=12, most=14):
    """Groups of near copies at all distances around the threshold, with shared passages and short texts."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    passage = [rng.choice(words) for _ in range(25)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([3, 5, 8, 30, 60, 90]))]
        for _ in range(rng.randint(1, most)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < 0.3:
                own = passage + own
            rows.append(" ".join(own).upper() if rng.random() < 0.2 else "  ".join(own))
    rng.shuffle(rows)
    return list(enumerate(rows + ["", "   ", "a", "A", "a b c d", "a b c d e", None], 100))


def frame(spark, rows, extra=False):
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string")
    more = [(d, t, 1, "x", {"k": "v"}, [1]) for d, t in rows]
    return spark.createDataFrame(more, "doc_id long, text string, block int, component_id string, members map<string,string>, _row array<int>")


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_brute_force(spark, seed):
    rows = noisy_corpus(seed)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_components(frame(spark, rows)).collect()}
    assert got == components(rows)


def test_op1_equals_brute_force(spark):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.op1_ngram_jaccard(spark, SMALL).collect()}
    assert got == components(rows_of(SMALL))


def test_chains_and_variants_without_their_base(spark):
    """Links that only form a chain, and copies that are each near the base but not each other."""
    rng = random.Random(1)
    base = [f"v{rng.randrange(10**6)}" for _ in range(200)]
    chain, now = [], list(base)
    for k in range(8):
        chain.append(" ".join(now))
        at = (k * 23) % 180
        now = [*now[:at], *(f"n{k}_{j}" for j in range(8)), *now[at + 8 :]]
    variants = []
    for k in range(12):
        own = list(base)
        for j in range(5):
            own[(k * 15 + j * 31) % 200] = f"x{k}_{j}"
        variants.append(" ".join(own).replace("v", "u"))
    rows = list(enumerate(chain + variants))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_components(frame(spark, rows)).collect()}
    assert got == components(rows)


def test_near_duplicates_of_odd_rows(spark):
    long = " ".join(f"t{k}" for k in range(30_000))
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (None, "q r s"), (9, None), (10, ""), (11, long), (12, long + " end"), (13, "same id"), (13, "same id"), (13, "other text here")]
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.near_components(frame(spark, rows, True)).collect())
    assert got == Counter([(None, 2, 7), (7, 2, 7), (None, 1, None), (9, 0, 9), (10, 0, 10), (11, 29_996, 11), (12, 29_997, 11), (13, 1, 13), (13, 1, 13), (13, 1, 13)])
    kept = jaccard_join.keep_one(frame(spark, rows, True))
    assert kept.columns == frame(spark, rows, True).columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [7, 9, 10, 11, 13, 13, 13]
    assert jaccard_join.near_components(frame(spark, [])).count() == 0 and jaccard_join.keep_one(frame(spark, [])).count() == 0


def kept_words(rows, window=20):
    docs = sorted((d, (t or "").encode().split()) for d, t in rows)
    first = {}
    for d, w in docs:
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), (d, i))
    out = {}
    for d, w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] != (d, i):
                gone[i : i + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out[d] = (len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def passages(seed):
    rng = random.Random(seed)
    words = [f"p{k}" for k in range(40)] + ["the"] * 10
    common = [[rng.choice(words) for _ in range(n)] for n in (19, 20, 21, 50, 70)]
    rows = []
    for _ in range(40):
        own = []
        for _ in range(rng.randint(0, 4)):
            own += rng.choice(common) if rng.random() < 0.5 else [rng.choice(words) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.2:
            own += ["run"] * rng.choice([18, 19, 20, 21, 45])
        if rng.random() < 0.2:
            own += ["tick", "tock"] * rng.choice([9, 10, 11, 30])
        rows.append(rng.choice([" ", "\n", "\t "]).join(own))
    return list(enumerate(rows + ["", None, " ", "one"]))


@pytest.mark.parametrize("seed", range(4))
def test_repeats_equal_brute_force(spark, seed):
    rows = passages(seed)
    random.Random(seed).shuffle(rows)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.remove_repeats(frame(spark, rows, seed == 0)).collect()}
    assert got == kept_words(rows)


def test_op6_equals_brute_force(spark):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.op6_substring_dedup(spark, SMALL).collect()}
    assert got == kept_words(rows_of(SMALL))


def test_repeats_in_odd_rows(spark):
    text = " ".join(f"k{i}" for i in range(25))
    rows = [(None, text), (3, text), (3, text), (-5, "x " + text)]
    got = sorted((str(r["doc_id"]), r["n_removed"], r["kept"]) for r in substring_dedup.remove_repeats(frame(spark, rows)).collect())
    assert got == sorted([("None", 0, text), ("3", 25, ""), ("3", 25, ""), ("-5", 25, "x")])
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0


def test_equal_windows_own_equal_symbols():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 6, 4000).astype(np.uint64)  # few words, so windows do repeat
    at, name, _ = substring_dedup.owners(hashes, np.array([0, 2500, 4000]))
    owned = {}
    for a, n in zip(at, name):
        assert owned.setdefault(hashes[a : a + 20].tobytes(), n) == n


def test_packed_columns_come_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        keys = np.sort(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        assert (unpack(pack(keys)) == keys).all()
        for kind in (np.uint8, np.uint32, np.int64):
            values = rng.integers(0, 200, n).astype(kind)
            assert (expand(squeeze(values), kind) == values).all()


def test_leaks_equal_sql(spark, same):
    same(spark, decontaminate.op9_decontaminate, OP9_SQL, SMALL)


@pytest.mark.parametrize("broadcast", [True, False])
def test_leaks_equal_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", 0)
    rng = random.Random(6)
    words = [f"w{k}" for k in range(50)]
    items = [(k, " ".join(rng.choice(words) for _ in range(n))) for k, n in enumerate([1, 3, 5, 6, 8, 20, 40, 41])] + [(98, ""), (99, None), (3, "w1 w1 w1 w1 w1 w2")]
    docs = []
    for k in range(60):
        own = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        item = rng.choice(items)[1]
        if item:
            given = item.split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                given[rng.randrange(len(given))] = "edit"
            own[rng.randint(0, len(own)) : 0] = given
        docs.append((k, " ".join(own)))
    docs += [(70, None), (71, ""), (72, items[6][1].upper())]
    whole = defaultdict(set)
    for i, t in items:
        whole[i] |= shingle_set(t)
    want = {(d, i): len(s & shingle_set(t)) for d, t in docs for i, s in whole.items() if s and 4 * len(s & shingle_set(t)) >= 3 * len(s)}
    found = decontaminate.leaks(frame(spark, docs, True), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]): r["shared"] for r in found.collect()} == want and want


def test_leaks_of_odd_rows(spark):
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    docs = frame(spark, [(None, "x a b c d e f g"), (None, "clean"), (2, "clean text"), (3, "A B C D E F G"), (3, "A B C D E F G")], True)
    kept = decontaminate.remove_leaks(docs, items)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [2]
    assert decontaminate.leaks(frame(spark, []), items).count() == 0
    assert decontaminate.remove_leaks(docs, items.where("false")).count() == 5
