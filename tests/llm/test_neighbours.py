"""Whole results, repeated rows and routing of the nearest-neighbour search."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from loomgraph.llm import neighbours


def ask(spark, rows, queries, **options):
    schema = "vec_id long, embedding array<double>"
    out = neighbours.nearest(spark.createDataFrame(rows, schema), spark.createDataFrame(queries, schema), **options)
    got = {}
    for r in out.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["rank"] == len(got[r["query_id"]])
    return got


@pytest.mark.parametrize("seed", range(3))
def test_all_that_are_asked_for_are_found(spark, seed):
    """25 vectors of which 20 lie together: the query's own row takes no place."""
    rng = np.random.default_rng(seed)
    points = rng.standard_normal((25, 8))
    points[5:] = points[5] + 0.001 * rng.standard_normal((20, 8))
    points /= np.linalg.norm(points, axis=1)[:, None]
    rows = [(k, p.tolist()) for k, p in enumerate(points)]
    got = ask(spark, rows, [rows[10], rows[0]])
    assert all(len(got[q]) == 20 and len(set(got[q])) == 20 and q not in got[q] for q in (0, 10))
    assert all(len(x) == 24 for x in ask(spark, rows, [rows[10]], k=30).values())


def test_repeated_rows_count_once(spark):
    rng = np.random.default_rng(1)
    rows = [(k, p.tolist()) for k, p in enumerate(rng.standard_normal((40, 6)))]
    once = ask(spark, rows, [rows[3], rows[4]])
    assert ask(spark, rows * 3, [rows[3], rows[4], rows[3]]) == once and len(set(once[3])) == 20
    # an id of several vectors is in a result once, at its best one; the least vector of a query id asks
    more = rows + [(7, rows[3][1]), (7, [0.1] * 6)]
    got = ask(spark, more, [rows[3], (3, [9.0] * 6)])
    want = sorted(range(40), key=lambda k: -np.dot(rows[3][1], rows[k][1]))
    best = sorted((k for k in range(40) if k not in (3, 7)), key=lambda k: -np.dot(rows[3][1], rows[k][1]))
    assert want and got[3].count(7) == 1 and set(got[3]) - {7} <= set(best[:20])


def test_short_results_are_asked_of_all_cells(spark):
    """Two far clusters, in one of which there are too few others."""
    rng = np.random.default_rng(2)
    near = rng.standard_normal((300, 4)) * 0.01 + [1, 0, 0, 0]
    few = rng.standard_normal((3, 4)) * 0.01 - [1, 0, 0, 0]
    rows = [(k, p.tolist()) for k, p in enumerate(np.vstack([near, few]))]
    got = ask(spark, rows, [rows[301], rows[5]], block=40)
    assert len(got[301]) == len(got[5]) == 20 and set(got[301]) >= {300, 302}


def test_clusters_are_visited_by_few_queries():
    """In clustered vectors the fitted number of cells is small beside all cells; in even ones it is not."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((40, 32)) * 3
    clustered = centres[rng.integers(0, 40, 4096)] + 0.1 * rng.standard_normal((4096, 32))
    even = rng.standard_normal((4096, 32))
    unit = lambda m: m / np.linalg.norm(m, axis=1)[:, None]
    count = lambda m: neighbours.fitted_probes(unit(m), 50_000, 6, 1.0, 20)
    assert count(clustered) <= 12 < count(even) <= 64


def test_probes_are_the_nearest_cells():
    rng = np.random.default_rng(5)
    queries = rng.standard_normal((20, 7))
    own, side = neighbours.cells(np.hstack([queries, np.zeros((20, 1))]), 5)
    got = neighbours.probes(queries, 5, 9)
    for q in range(20):
        cost = {c: sum(side[q, b] ** 2 for b in range(5) if (c ^ own[q]) >> b & 1) for c in range(32)}
        assert got[q].tolist() == sorted(cost, key=lambda c: cost[c])[:9]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall(spark, folder):
    t = pq.read_table(f"{folder}/embeddings.parquet").to_pydict()
    ids, vectors = np.array(t["vec_id"]), np.array(t["embedding"], float)
    got = {}
    for r in neighbours.op8_hash_prefix_forest(spark, folder).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = []
    for q in np.flatnonzero(ids % 20 == 0):
        near = [i for i in ids[np.lexsort((ids, -(vectors @ vectors[q])))[:25]] if i != ids[q]][:20]
        assert len(got[ids[q]]) == 20
        hits.append(len(got[ids[q]] & set(near)) / 20)
    assert np.mean(hits) >= 0.9
