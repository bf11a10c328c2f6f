import random
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F

from loomgraph import checks
from loomgraph.graph import centrality as central
from loomgraph.graph.components import connected_components
from loomgraph.operators import dedup, metadata, resolve, retrieval, views
from loomgraph.plans import paths


def frames(spark, nodes, edges):
    return spark.createDataFrame([(n,) for n in nodes], "id int"), spark.createDataFrame(edges, "src int, dst int")


def brandes(nodes, edges):
    """Distances, betweenness and closeness by search from each node."""
    out = defaultdict(set)
    for a, b in edges:
        if a != b:
            out[a].add(b)
    between, reach = dict.fromkeys(nodes, 0.0), defaultdict(list)
    for s in nodes:
        order, before, sigma, dist, queue = [], defaultdict(list), defaultdict(float, {s: 1.0}), {s: 0}, deque([s])
        while queue:
            v = queue.popleft()
            order.append(v)
            for w in out[v]:
                if w not in dist:
                    dist[w] = dist[v] + 1
                    queue.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
                    before[w].append(v)
        part = defaultdict(float)
        for w in reversed(order):
            for v in before[w]:
                part[v] += sigma[v] / sigma[w] * (1 + part[w])
            if w != s:
                between[w] += part[w]
                reach[w].append(dist[w])
    return between, {n: len(reach[n]) / sum(reach[n]) if reach[n] else 0.0 for n in nodes}


def ranks(nodes, edges):
    out = defaultdict(int)
    for a, _ in edges:
        out[a] += 1
    r = dict.fromkeys(nodes, 0.15)
    for _ in range(20):
        new = dict.fromkeys(nodes, 0.15)
        for a, b in edges:
            new[b] += 0.85 * r[a] / out[a]
        r = new
    return r


random.seed(4)
GRAPHS = {
    "random": (range(40), [(random.randrange(40), random.randrange(40)) for _ in range(110)]),
    "dag": (range(6), [(0, 1), (0, 2), (1, 3), (2, 3), (3, 4)]),
    "cycle": (range(4), [(0, 1), (1, 2), (2, 3), (3, 0)]),
    "parallel and loops": (range(4), [(0, 1), (0, 1), (1, 1), (1, 2)]),
}


@pytest.mark.parametrize("name", GRAPHS)
def test_centrality_equals_search(spark, name):
    nodes, edges = GRAPHS[name]
    got = {r["id"]: r for r in central.centrality(*frames(spark, nodes, edges)).collect()}
    between, close = brandes(nodes, edges)
    rank = ranks(nodes, edges)
    for n in nodes:
        assert got[n]["degree"] == sum(a == n for a, _ in edges)
        assert got[n]["pagerank"] == pytest.approx(rank[n], abs=1e-9)
        assert got[n]["betweenness"] == pytest.approx(between[n], abs=1e-9)
        assert got[n]["closeness"] == pytest.approx(close[n], abs=1e-9)
        assert 0 <= got[n]["combined"] <= 1


def test_sampled_centrality_keeps_the_exact_measures(spark):
    nodes, edges = GRAPHS["random"]
    got = {r["id"]: r for r in central.centrality(*frames(spark, nodes, edges), max_exact=15).collect()}
    rank = ranks(nodes, edges)
    assert all(got[n]["pagerank"] == pytest.approx(rank[n]) for n in nodes)


def test_centrality_of_nothing(spark):
    assert central.centrality(*frames(spark, [], [])).count() == 0
    assert [r["combined"] for r in central.centrality(*frames(spark, [1], [])).collect()] == [0.0]


@pytest.mark.parametrize("name", ["cycle", "parallel and loops"])
def test_closeness_by_reach_equals_search(spark, name):
    nodes, edges = GRAPHS[name]
    _, close = brandes(nodes, edges)
    got = {r["id"]: r["closeness"] for r in central.closeness_by_reach(*frames(spark, nodes, edges)).collect()}
    assert got == {n: pytest.approx(close[n], abs=1e-12) for n in nodes}


def test_closeness_by_reach_of_many_targets(spark, monkeypatch):
    monkeypatch.setattr(central, "shortest_paths", None)  # no row for each pair
    monkeypatch.setattr(central, "HELD_BYTES", 150_000)  # two blocks of targets
    monkeypatch.setattr(central, "GROUP_EDGES", 900)
    edges = [(random.randrange(1500), random.randrange(1300)) for _ in range(4500)] + [(2000 + k, k % 7) for k in range(300)]
    nodes = sorted({x for e in edges for x in e} | {9000})
    _, close = brandes(nodes, edges)
    got = {r["id"]: r["closeness"] for r in central.closeness_by_reach(*frames(spark, nodes, edges)).collect()}
    assert got == {n: pytest.approx(close[n], abs=1e-12) for n in nodes}
    assert [tuple(r) for r in central.closeness_by_reach(*frames(spark, [1], [(1, 1)])).collect()] == [(1, 0.0)]


def test_equal_values_scale_to_zero(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id int, degree double")
    assert [r["combined"] for r in central.combine(rows, ["degree"]).collect()] == [0.0, 0.0]


def test_projection_needs_both_ends(spark):
    nodes = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, label string")
    edges = spark.createDataFrame([(1, 2, "r"), (1, 3, "r"), (2, 1, "s")], "src int, dst int, rel_type string")
    own, kept = central.project(nodes, edges, spark.createDataFrame([("a",), ("b",)], "label string"), spark.createDataFrame([("r",)], "rel_type string"))
    assert sorted(r["id"] for r in own.collect()) == [1, 2] and [tuple(r) for r in kept.collect()] == [(1, 2)]
    own, kept = central.project(nodes, edges, spark.createDataFrame([], "label string"), spark.createDataFrame([("r",)], "rel_type string"))
    assert own.count() == 0 and kept.count() == 0


COMPONENTS = {
    "none": [],
    "loop": [(1, 1)],
    "pair": [(2, 1)],
    "triangle": [(1, 2), (2, 3), (3, 1)],
    "bridged": [(1, 2), (2, 3), (3, 1), (7, 8), (8, 9), (9, 7), (3, 7)],
    "chain": [(k, k + 1) for k in range(0, 60)],
    "star": [(50, k) for k in range(100, 160)],
    "apart": [(5, 6), (6, 5), (1, 2)],
    "random": [(random.randrange(200), random.randrange(200)) for _ in range(120)],
}


@pytest.mark.parametrize("name", COMPONENTS)
def test_components(spark, name):
    edges, parent = COMPONENTS[name], {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "src int, dst int")).collect()}
    assert got == {n: root(n) for n in list(parent)}


def test_masters_only_of_members(spark):
    similar = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y")], "src string, dst string")
    members = spark.createDataFrame([("a",), ("b",), ("x",)], "entity_id string")
    assert sorted(map(tuple, resolve.component_masters(similar, members).collect())) == [("a", "a"), ("a", "b")]
    assert tuple(resolve.master_stats(resolve.component_masters(similar)).first()) == (2, 5)


CHUNK = "chunk_id string, filename string, index int, text string, embedding array<float>"


def test_duplicates_need_file_text_and_embedding(spark):
    rows = [("c1", "f", 3, "t", None), ("c2", "f", 1, "t", None), ("c3", "g", 1, "t", None), ("c4", "f", 2, "t", [1.0]), ("c5", "f", None, "t", None), ("c6", "", 1, "t", None), ("c7", None, 1, "t", None), ("c8", "", 2, "t", None), ("d1", "f", 9, "u", [2.0]), ("d0", "f", 9, "u", [2.0]), ("e1", "f", None, None, None), ("e0", "f", None, None, None), ("e2", "f", None, "", None)]
    chunks = spark.createDataFrame(rows, CHUNK)
    groups = [(r["filename"], r["survivor"], r["copies"]) for r in dedup.duplicate_groups(chunks).collect()]
    assert groups == [("f", "c2", 3), ("f", "d0", 2), ("f", "e0", 2)]
    kept = dedup.drop_duplicates(chunks)
    assert sorted(r["chunk_id"] for r in kept.collect()) == sorted({r[0] for r in rows} - {"c1", "c5", "d1", "e1"})
    assert dedup.duplicate_groups(kept).count() == 0
    # equal text of another embedding still counts as left over
    report = dedup.verify_merge(kept, dedup.next_chunks(kept)).first()
    assert report["duplicate_groups_remaining"] == 2 and report["chain_complete"]


def test_edges_follow_their_survivors(spark):
    kind = "src string, dst string, rel_type string, props map<string,string>"
    edges = spark.createDataFrame([
        ("s", "x", "R", {"a": "0", "k": "0"}), ("m1", "x", "R", {"a": "1"}), ("m2", "x", "R", {"a": "2", "b": "2"}), ("x", "m1", "R", {}), ("m1", "s", "R", {}), ("s", "m2", "R", {}), ("m1", "m2", "R", {}),
        ("s", "s", "L", {}), ("m1", "m1", "L", {}), ("p", "q", "R", {"n": "1"}), ("p", "q", "R", {"n": "2"}), ("m1", "x", "T", None),
    ], kind)
    mapping = spark.createDataFrame([("s", "s", 0), ("m1", "s", 1), ("m2", "s", 2)], "node string, survivor string, place int")
    got = sorted((r["src"], r["dst"], r["rel_type"], tuple(sorted((r["props"] or {}).items()))) for r in dedup.repoint_edges(edges, mapping).collect())
    assert got == sorted([("s", "x", "R", (("a", "2"), ("b", "2"), ("k", "0"))), ("x", "s", "R", ()), ("s", "s", "L", ()), ("p", "q", "R", (("n", "1"),)), ("p", "q", "R", (("n", "2"),)), ("s", "x", "T", ())])


def test_chain_is_rebuilt_only_after_a_merge(spark):
    chunks = spark.createDataFrame([("a", "f", 1, "t", None), ("b", "f", 7, "u", None), ("c", "g", 1, "t", None), ("d", "f", None, "v", None)], CHUNK)
    old = spark.createDataFrame([("f", "b", "a")], "filename string, src string, dst string")
    assert [tuple(r) for r in dedup.merge_chunks(chunks, old)[1].collect()] == [("f", "b", "a")]
    more = chunks.unionByName(spark.createDataFrame([("e", "f", 3, "t", None)], CHUNK))
    kept, chain = dedup.merge_chunks(more, old)
    assert [tuple(r) for r in chain.collect()] == [("f", "a", "b")] and kept.count() == 4
    report = dedup.merge_report(more, kept, chain).first()
    assert report["success"] and report["merged_chunks"] == 1 and report["compression_percent"] == 20.0
    none = spark.createDataFrame([], CHUNK)
    assert dedup.merge_report(none, none, dedup.next_chunks(none)).first()["success"]


VIEWS = [(0, "MPU", "mp_Method"), (1, "EBM", "mp_Method"), (2, "EEM", "mp_Method"), (0, "MPU", "mp_Claim"), (1, "EBM", "whu_Device"), (2, "EEM", "whu_Device")]


def test_views_of_entities(spark):
    mapping = spark.createDataFrame(VIEWS, "view_order int, view string, label string")
    rows = spark.createDataFrame([("a", "mp_Claim", ["mp_Claim"], None), ("b", "mp_Method", ["mp_Method"], "old"), ("c", "mp_Claim", ["whu_Device", "mp_Claim"], None), ("d", "zz", ["zz"], "kept"), ("e", "Chunk", ["Chunk", "mp_Claim"], None)], "entity_id string, label string, labels array<string>, subgraph string")
    got = {r["entity_id"]: (r["subgraphs"], r["subgraph"]) for r in views.assign_views(rows, mapping).collect()}
    assert got == {"a": (["MPU"], "MPU"), "b": (["MPU", "EBM", "EEM"], None), "c": (["EBM", "EEM"], None), "d": (None, "kept"), "e": (None, None)}
    once = views.assign_views(rows, mapping)
    assert sorted(map(str, views.assign_views(once, mapping).collect())) == sorted(map(str, once.collect()))
    assert views.uncovered(once, mapping).count() == 0
    with pytest.raises(ValueError):
        views.checked_views(rows.where("entity_id = 'd'"), mapping)
    assert sorted(map(tuple, views.mapping_differences(mapping, rows.where("label <> 'Chunk'")).collect())) == [("whu_Device", "ontology"), ("zz", "mapping")]


def test_exact_resolution_is_per_label(spark):
    entities = spark.createDataFrame([("e2", "A", "x"), ("e1", "A", "x"), ("e3", "B", "x"), ("e4", "A", None), ("e5", "A", None)], "entity_id string, label string, name string")
    relations = spark.createDataFrame([("r2", "e2", "e3", "T"), ("r1", "e1", "e3", "T"), ("r3", "e3", "e2", "T")], "rel_id string, src string, dst string, rel_type string")
    kept, moved = resolve.resolve_exact(entities, relations)
    assert sorted(r["entity_id"] for r in kept.collect()) == ["e1", "e3", "e4", "e5"]
    assert sorted(map(tuple, moved.collect())) == [("r1", "e1", "e3", "T"), ("r3", "e3", "e1", "T")]


META = "dc_title string, dc_author string, dc_publisher string, dc_type string, dc_language string, dcterms_identifier string"


def test_metadata_flows_down_once(spark):
    docs = spark.createDataFrame([("a.md", "T", "A", None, None, None, None)], f"filename string, {META}")
    kind = f"chunk_id string, filename string, index int, text string, section_role string, from_section string, source_doc string, {META}"
    none = (None,) * 6
    chunks = spark.createDataFrame([("c1", "a.md", 2, "Alpha caused Beta. x", "Results", None, None, *none), ("c0", "a.md", 1, "y", None, None, None, *none), ("c9", "b.md", 1, "z", None, None, None, *none), ("c8", "a.md", None, "w", None, None, None, "own", *none[1:])], kind)
    done = metadata.chunk_metadata(chunks, docs)
    got = {r["chunk_id"]: (r["dc_title"], r["dc_publisher"], r["dcterms_identifier"], r["from_section"], r["source_doc"]) for r in done.collect()}
    assert got == {"c1": ("T", "Unknown", "local:a", "Results", "a"), "c0": ("T", "Unknown", "local:a", "Other", "a"), "c9": (None,) * 5, "c8": ("own", None, None, None, None)}
    assert sorted(map(str, metadata.chunk_metadata(done, docs).collect())) == sorted(map(str, done.collect()))
    held = spark.createDataFrame([("e1", "c1"), ("e1", "c0"), ("e2", "c1")], "entity_id string, chunk_id string")
    entities = spark.createDataFrame([("e1", "Alpha", None, None), ("e2", "Beta", None, None), ("e3", "n", None, None)], "entity_id string, name string, dc_title string, from_section string")
    inherited = metadata.entity_metadata(entities, held, done)
    assert {r["entity_id"]: (r["dc_title"], r["from_section"]) for r in inherited.collect()} == {"e1": ("T", "Other"), "e2": ("T", "Results"), "e3": (None, None)}
    relations = spark.createDataFrame([("r1", "e2", "e3", "causes_it", None, None, None, None, None, None), ("r2", "e3", "e3", "x", None, None, None, None, None, None), ("r3", "e1", "e2", "x", "n", "given", 0.0, None, None, None)], "rel_id string, src string, dst string, rel_type string, name string, original_text string, llm_weight double, dcterms_identifier string, dc_title string, from_section string")
    assert {r["rel_id"]: r["from_section"] for r in metadata.relation_metadata(relations, held, done).collect()} == {"r1": "Results", "r2": None, "r3": "Other"}
    told = {r["rel_id"]: (r["name"], r["original_text"], r["llm_weight"], r["dcterms_identifier"]) for r in metadata.enhance_relations(relations, entities, held, done).collect()}
    assert told == {"r1": ("causes it", "Alpha caused Beta. x...", 0.85, ""), "r2": (None, None, None, None), "r3": ("n", "given", 0.0, None)}


def test_backfill_last_node_wins_and_counts_matches(spark):
    stored = spark.createDataFrame([("c1", None, "say hello world", None, None, None, None), ("c2", "g", "hello", None, None, None, None), ("c3", "f", "hello", None, None, None, None)], "chunk_id string, filename string, text string, header_path string, section_role string, from_section string, view_roles array<string>")
    nodes = spark.createDataFrame([(0, "f", " hello ", "P0", "Results", ["MPU"]), (1, "f", "hello", None, None, []), (2, "f", " ", "P", "Results", [])], "ordinal int, filename string, text string, header_path string, section_role string, view_roles array<string>")
    out, count = metadata.backfill_chunks(stored, nodes)
    got = {r["chunk_id"]: (r["filename"], r["header_path"], r["from_section"]) for r in out.collect()}
    assert got == {"c1": ("f", "Unknown", "Other"), "c2": ("g", None, None), "c3": ("f", "Unknown", "Other")} and count.first()["matches"] == 4


def test_preflight_and_path_checks(spark):
    nodes = spark.createDataFrame([("a", "A", "an"), ("b", "B", None)], "id string, label string, name string")
    edges = spark.createDataFrame([("r", "a", "b", "T")], "rel_id string, src string, dst string, rel_type string")
    templates = spark.createDataFrame([("MPU", "A", "T", "B"), ("EBM", "B", "T", "A")], "view string, subject string, relation string, object string")
    counted = paths.template_counts(templates, edges, nodes)
    cen = spark.createDataFrame([("EBM", "a", 0.7), ("EBM", "b", None)], "view string, entity_id string, pagerank double")
    assert paths.preflight(counted, cen)["EBM"]["zero"] == 1
    with pytest.raises(ValueError, match="instance"):
        paths.preflight(paths.template_counts(templates, edges.where("false"), nodes), cen)
    with pytest.raises(ValueError, match="rank"):
        paths.preflight(counted, cen.where("pagerank is null"))
    low = paths.low_paths(edges, nodes, templates, paths.best_rank(cen))
    row = low.first()
    assert row["text"] == "an T b" and row["max_pagerank"] == 0.7  # the other view's rank
    groups = spark.createDataFrame([("MPU", 1, "a", "an", "b", None), ("MPU", 0, "z", "Plan", "b", "bee"), ("EBM", 0, "z", "Plan", "a", None)], "view string, kind int, anchor_id string, anchor_name string, member_id string, member_name string")
    mid = paths.mid_paths(groups, paths.best_rank(cen))
    assert {(r["view"], r["anchor_id"]): (r["counter"], r["text"]) for r in mid.collect()} == {("MPU", "z"): (1, "Plan: bee"), ("MPU", "a"): (2, "an: b"), ("EBM", "z"): (1, "Plan: a")}
    held = spark.createDataFrame([("a", "c"), ("b", "c")], "entity_id string, chunk_id string")
    links = paths.link_paths(mid, low, held)
    assert links.count() == 1 and paths.details_of(links).columns == ["src", "dst"]
    assert paths.check_paths(low, mid, links)["has_detail_path"] == 1
    for args, said in (((low.where("false"), mid, links), "low"), ((low, mid.where("false"), links), "mid"), ((low, mid, links.where("false")), "linked"), ((low.withColumn("max_pagerank", F.lit(None)), mid, links), "rank")):
        with pytest.raises(ValueError, match=said):
            paths.check_paths(*args)


def test_sentences_and_embeddings_of_paths(spark):
    rows = spark.createDataFrame([("1", "a b", None, None), ("2", "c", "given", None), ("3", None, None, None), ("4", "boom", None, [1.0])], "mp_id string, text string, query string, embedding array<float>")

    def ask(t):
        if t == "boom":
            raise RuntimeError("down")
        return "short"

    got = {r["mp_id"]: r["query"] for r in paths.path_sentences(rows, ask).collect()}
    assert got == {"1": "short", "2": "given", "3": None, "4": None}
    filled = {r["mp_id"]: r["embedding"] for r in paths.path_embeddings(paths.path_sentences(rows), dims=8).collect()}
    assert filled["3"] is None and filled["4"] == [1.0] and sum(x * x for x in filled["1"]) == pytest.approx(1, abs=1e-6)
    own = {r["mp_id"]: r["embedding"] for r in paths.path_embeddings(rows, lambda ts: [[float(len(t))] for t in ts]).collect()}
    assert own["2"] == [5.0]


def test_cosine_search_both_ways(spark, monkeypatch):
    random.seed(2)
    rows = spark.createDataFrame([(k, [random.gauss(0, 1) for _ in range(4)]) for k in range(60)], "id int, embedding array<double>")
    asked = rows.where("id % 7 = 0")
    few = sorted(map(tuple, retrieval.nearest_by_cosine(rows, asked).collect()))
    monkeypatch.setattr(retrieval, "BROADCAST_QUERIES", 0)
    assert sorted(map(tuple, retrieval.nearest_by_cosine(rows, asked, blocks=5).collect())) == few and len(few) == 27


def test_cosine_search_scores_as_the_expression_does(spark, monkeypatch):
    from pyspark.sql import Window

    from loomgraph.functions.text import cosine

    random.seed(5)
    some = [[random.gauss(0, 1) for _ in range(9)] for _ in range(150)]
    odd = [None, [], [0.0] * 9, [1.0] * 3, [2.0] * 3, [1.0, None] + [1.0] * 7, [1e-170] * 9, [1e170] * 9, [float("nan")] * 9, [1.0] * 8 + [float("inf")]]
    vectors = some + odd + some[:3] * 20  # many ties
    order = random.sample(range(len(vectors)), len(vectors))
    rows = spark.createDataFrame([(f"n{k:03}", vectors[k]) for k in order] + [(None, some[0])], "id string, embedding array<double>")
    asked = rows.where("id < 'n020' or id > 'n140'")
    a, b = rows.alias("a"), asked.alias("b")
    pairs = b.join(a, F.col("a.id") != F.col("b.id")).select(F.col("b.id").alias("query_id"), F.col("a.id").alias("id"), cosine(F.col("a.embedding"), F.col("b.embedding")).alias("score")).where("score is not null")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    want = sorted(map(str, pairs.withColumn("rank", best).where("rank <= 3").select("query_id", "rank", "id", "score").collect()))
    found = retrieval.nearest_by_cosine(rows, asked, blocks=2)
    # pairs are not rows of a plan: products of matrices take their place
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, found.collect())) == want
    monkeypatch.setattr(retrieval, "BROADCAST_QUERIES", 40)
    monkeypatch.setattr(retrieval, "_SIDE", 7)
    assert sorted(map(str, retrieval.nearest_by_cosine(rows, asked, blocks=3).collect())) == want


def test_checks_find_what_breaks_rules(spark):
    nodes = spark.createDataFrame([("s1", "Step"), ("s2", "Step"), ("p", "Plan")], "id string, label string")
    edges = spark.createDataFrame([("s1", "p", "of")], "src string, dst string, rel_type string")
    assert [tuple(r) for r in checks.wrong_cardinality(nodes, edges, "Step", "of").collect()] == [("s2", 0)]
    assert checks.forbidden_edges(nodes, edges, "of", "Step", "Plan").count() == 1
    assert checks.values_outside(nodes, "label", ["Step"]).count() == 1
    with pytest.raises(ValueError, match="steps"):
        checks.raise_if_any(checks.wrong_cardinality(nodes, edges, "Step", "of"), "steps without one plan")


def test_ranks_do_not_depend_on_names(spark):
    nodes, edges = GRAPHS["random"]
    other = {n: (n * 17 + 5) % 41 for n in nodes}
    a = {r["id"]: r["pagerank"] for r in central.pagerank(*frames(spark, nodes, edges)).collect()}
    b = {r["id"]: r["pagerank"] for r in central.pagerank(*frames(spark, other.values(), [(other[x], other[y]) for x, y in edges])).collect()}
    assert all(a[n] == pytest.approx(b[other[n]]) for n in nodes)
