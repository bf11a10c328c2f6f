"""Queries on whole tables: no id of the tables may be missing."""

from loomgraph.queries.catalog import ORACLES, QUERIES

# a folder with more than a few suppliers and parts
MORE = "/root/testdata/sf0.01"


def test_every_supplier_is_linked(spark, same):
    same(spark, QUERIES["path_links"], ORACLES["path_links"], MORE)
    same(spark, QUERIES["path_counts"], ORACLES["path_counts"], MORE)
    used = spark.read.parquet(f"{MORE}/lineitem.parquet").selectExpr("concat('S', l_suppkey)").distinct().collect()
    linked = QUERIES["path_links"](spark, MORE).select("mid_id").distinct().collect()
    assert {r[0] for r in linked} == {r[0] for r in used} and len(used) > 19


def test_centrality_of_whole_graphs(spark, same):
    for name in ("betweenness", "pagerank_cyclic", "closeness_cyclic"):
        same(spark, QUERIES[name], ORACLES[name], MORE)
    suppliers = spark.read.parquet(f"{MORE}/supplier.parquet").count()
    assert QUERIES["betweenness"](spark, MORE).where("id like 'S%'").count() == suppliers
    parts = spark.read.parquet(f"{MORE}/lineitem.parquet").select("l_partkey").distinct().count()
    assert QUERIES["pagerank_cyclic"](spark, MORE).count() >= parts > 60


def test_every_relation_and_low_path_counts(spark, same):
    for name in ("meta_relation", "path_max_rank"):
        same(spark, QUERIES[name], ORACLES[name], MORE)
    lines = spark.read.parquet(f"{MORE}/lineitem.parquet").select("l_orderkey", "l_partkey").distinct().count()
    assert QUERIES["meta_relation"](spark, MORE).where("rel_id like '%|contains|%'").count() == lines
    assert QUERIES["path_max_rank"](spark, MORE).count() == QUERIES["paths_low"](spark, MORE).count()
