import pytest

from loomgraph.graph import centrality as central
from tests.test_graph import GRAPHS, brandes, frames


def test_blocks_of_sources_give_exact_measures(spark):
    nodes, edges = GRAPHS["random"]
    got = {r["id"]: r for r in central.centrality(*frames(spark, nodes, edges), max_exact=15).collect()}
    between, close = brandes(nodes, edges)
    assert len(got) > 15
    for n in nodes:
        assert got[n]["betweenness"] == pytest.approx(between[n], abs=1e-9)
        assert got[n]["closeness"] == pytest.approx(close[n], abs=1e-9)
