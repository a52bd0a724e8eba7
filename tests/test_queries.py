import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from checking import both
from edgetide.operators import stats
from edgetide.plans import oracle
from edgetide.plans.queries import registered
from edgetide.operators.trace import trace
from edgetide.sources.tables import GRAPHS
from edgetide.storage import store

# Expected top five, ten rounds, damping 0.85.
TOP5 = {
    ("part_next", "0.001"): "144 1.61797773, 179 1.47736936, 7 1.40265269, 80 1.38058321, "
    "157 1.34052622",
    ("part_next", "0.01"): "558 1.63290203, 706 1.61328525, 1909 1.60659713, "
    "1936 1.59552277, 1405 1.59339753",
    ("nation_trade", "0.01"): "NATION_9 2.2615241, NATION_11 1.61072052, NATION_6 1.60458398, "
    "NATION_7 1.45375797, NATION_19 1.43743581",
}
KEYS = {"part_next": "top5", "nation_trade": "top5_nation_trade"}


@pytest.mark.parametrize("graph,sf", TOP5)
def test_known_top_five(spark, graph, sf):
    rows = driver.queries()[KEYS[graph]](spark, f"/root/testdata/sf{sf}").collect()
    expected = [entry.split(" ") for entry in TOP5[graph, sf].split(", ")]
    assert [(r["rank"], r.nodeId, r.pagerank) for r in rows] == [
        (place, node, float(score)) for place, (node, score) in enumerate(expected, start=1)
    ]


# edges, distinct edges, nodes, sources, targets, self-loops, sinks, nodes without in-edge
SIZES = {
    "part_next": (4527, 4292, 200, 200, 200, 17, 0, 0),
    "part_supp": (6000, 1905, 200, 200, 10, 35, 0, 190),
    "nation_trade": (6000, 250, 25, 25, 10, 235, 0, 15),
    "page_links": (281, 279, 305, 50, 255, 0, 255, 50),
}


@pytest.mark.parametrize("graph", SIZES)
def test_known_sizes(spark, sf001, graph):
    edges = GRAPHS[graph](spark, sf001)
    row = stats.graph_stats(edges).first()
    distinct = stats.count_edges(edges)
    assert SIZES[graph] == (
        row.total_edges,
        distinct.count(),
        row.total_nodes,
        row.source_nodes,
        stats.in_degree(edges).count(),
        distinct.where("src = dst").agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0],
        stats.sink_nodes(edges).count(),
        stats.no_inlink_nodes(edges).count(),
    )


# nodes by smallest hop
HOPS = {
    ("part_next", "558", 3): [1, 41, 759, 1199],
    ("part_supp", "1999", 2): [1, 24, 76],
    ("nation_trade", "NATION_9", 2): [1, 24],
}


@pytest.mark.parametrize("graph,start,hops", HOPS)
def test_known_hops(spark, graph, start, hops):
    edges, _ = store(GRAPHS[graph](spark, "/root/testdata/sf0.01"), "edges")
    starts = spark.createDataFrame([(start,)], "nodeId string")
    counts = dict(trace(edges, starts, hops).groupBy("hop").count().collect())
    assert [counts[hop] for hop in sorted(counts)] == HOPS[graph, start, hops]


def test_every_query_has_sql():
    assert list(registered()) == list(oracle.statements())


@pytest.mark.parametrize("name", registered())
def test_query_equals_sql(spark, sf001, name):
    ours, sql = both(spark, name, sf001)
    assert ours == sql


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["rank", "nodeId", "pagerank"] and df.count() == 5
