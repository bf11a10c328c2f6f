import pytest

from loomgraph.queries.catalog import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, same, name):
    same(spark, QUERIES[name], ORACLES[name], SMALL)


def test_entry_gives_rows(spark):
    import __spark_entry__ as e

    rows = e.entry(spark).collect()
    assert rows and all(r["kept"] <= r["chunks"] and r["links"] == r["kept"] - 1 for r in rows)


def test_entry_points_agree():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and set(QUERIES) <= set(e.queries())
