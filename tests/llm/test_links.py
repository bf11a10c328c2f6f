"""Numbers of links against brute force."""

import random
import sys
from collections import Counter
from pathlib import Path

import pytest

from loomgraph.llm import jaccard_join, substring_dedup

sys.path.insert(0, str(Path(__file__).parent))
from test_pairs import SMALL, components, frame, noisy_corpus, rows_of, shingle_set  # noqa: E402


def links(rows):
    sets = [shingle_set(t) for _, t in rows]
    similar = lambda a, b: a and b and 100 * len(a & b) >= 75 * len(a | b)
    return Counter((d, sum(bool(similar(s, o)) for j, o in enumerate(sets) if j != i)) for i, ((d, _), s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("seed, piece", [(0, 1 << 23), (1, 1 << 23), (2, 2000), (3, 500)])
def test_links_equal_brute_force(spark, monkeypatch, seed, piece):
    monkeypatch.setattr(jaccard_join, "PIECE_BYTES", piece)
    monkeypatch.setattr(jaccard_join, "COLUMNS", 64)
    rows = noisy_corpus(seed, groups=8)
    got = jaccard_join.near_components(frame(spark, rows), links=True).collect()
    assert Counter((r["doc_id"], r["n_links"]) for r in got) == links(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == components(rows)


def test_op1_links_equal_brute_force(spark):
    rows = rows_of(SMALL)
    got = jaccard_join.op1_ngram_jaccard(spark, SMALL).collect()
    assert Counter((r["doc_id"], r["n_links"]) for r in got) == links(rows)
    sets, first = {d: shingle_set(t) for d, t in rows}, {}
    for d, s in sorted(sets.items()):
        first.setdefault(s, d)
    assert all(r["class_id"] == (first[sets[r["doc_id"]]] if sets[r["doc_id"]] else r["doc_id"]) for r in got)


def test_sql_gives_the_same(spark, same):
    same(spark, jaccard_join.op1_ngram_jaccard, jaccard_join.OP1_SQL, SMALL)
    same(spark, substring_dedup.op6_substring_dedup, substring_dedup.OP6_SQL, SMALL)


def test_a_group_of_many_components(spark):
    """Texts of one prefix and size that are not all alike: the group meets itself."""
    rng = random.Random(4)
    rows = []
    for k in range(30):
        tail = [f"t{rng.randrange(6)}" for _ in range(12)]
        rows.append((k, " ".join(["rare one two three four five six"] + tail)))
    got = jaccard_join.near_components(frame(spark, rows), links=True).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == components(rows)
    assert Counter((r["doc_id"], r["n_links"]) for r in got) == links(rows)


def test_links_of_odd_rows(spark):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (8, None), (9, " "), (10, "same"), (10, "same"), (11, "SAME")]
    got = Counter((r["doc_id"], r["n_links"]) for r in jaccard_join.near_components(frame(spark, rows, True), links=True).collect())
    assert got == Counter([(None, 1), (7, 1), (8, 0), (9, 0), (10, 2), (10, 2), (11, 2)])
    assert jaccard_join.near_components(frame(spark, []), links=True).count() == 0
