import pytest

import brute
from edgetide.operators.trace import connection, trace, trace_each, trace_paths


def ids(spark, names):
    return spark.createDataFrame([(name,) for name in names], "nodeId string")


@pytest.mark.parametrize("back", [False, True])
@pytest.mark.parametrize("slice_rows", [1_000_000, 5])
def test_paths_lead_from_a_start_by_the_least_node(spark, make_edges, back, slice_rows):
    pairs = brute.random_edges(200, 420, seed=41, hub_share=20)
    starts = ["n3", "n5", "nowhere"]
    rows = trace_paths(make_edges(pairs), ids(spark, starts), 5, back, slice_rows).collect()
    hops = brute.hops(pairs, starts, 5, back)
    assert {row.nodeId: row.hop for row in rows} == hops and len(rows) == len(hops)
    links = {(b, a) for a, b in pairs} if back else set(pairs)
    best = {start: [start] for start in starts}
    for hop in range(1, 6):
        for node in [n for n, h in hops.items() if h == hop]:
            via = min(a for a, b in links if b == node and hops.get(a) == hop - 1)
            best[node] = [*best[via], node]
    assert {row.nodeId: list(row.path) for row in rows} == best


def test_visited_nodes_take_one_join_and_links_stay(spark, make_edges, monkeypatch):
    from edgetide.operators import links, trace as module

    monkeypatch.setattr(links, "FEW_ROWS", 2)
    plans, usual = [], module.checkpoint

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return usual(df)

    monkeypatch.setattr(module, "checkpoint", seen)
    chain = [(f"n{i}", f"n{i + 1}") for i in range(10)]
    assert trace(make_edges(chain), ids(spark, ["n0"]), 8).count() == 9
    last = plans[-1]
    assert last.count("LeftAnti") == 1 and last.count("Union") == 1
    # ids of targets and of visited nodes move; links did once, below the cached edges
    assert last.count("Exchange hashpartitioning(nodeId") <= 2
    assert last.count("Exchange hashpartitioning(src") == 1


def test_connections_are_as_far_as_a_trace_says(spark, make_edges):
    pairs = brute.random_edges(300, 700, seed=42, hub_share=30)
    edges = make_edges(pairs)
    hops = brute.hops(pairs, ["n1"], 9)
    far = max(hops.values())
    targets = [next(n for n, h in hops.items() if h == k) for k in (0, 1, 3, far)]
    for target in targets:
        row = connection(edges, "n1", target, 9).first()
        assert (row.source, row.target, row.distance) == ("n1", target, hops[target])
        assert (row.path[0], row.path[-1], len(row.path)) == ("n1", target, row.distance + 1)
        assert all(link in pairs for link in zip(row.path, row.path[1:]))
    # both walks together meet fewer nodes than one
    assert row.visited < len(hops)
    assert connection(edges, "n1", targets[-1], far - 1).collect() == []
    assert connection(edges, "n1", "nowhere", 3).collect() == []
    assert connection(edges, "nowhere", "nowhere", 3).collect() == []
    assert connection(make_edges([("a", "b")]), "b", "a", 5).collect() == []
    with pytest.raises(ValueError):
        connection(edges, "a", "b", -1)


@pytest.mark.parametrize("back", [False, True])
def test_starts_stay_apart(spark, make_edges, back):
    pairs = brute.random_edges(120, 260, seed=43, hub_share=20)
    starts = [f"n{i}" for i in range(150)]  # three bitmaps, some of ids that have no edge
    rows = trace_each(make_edges(pairs), ids(spark, starts + starts[:3]), 3, back).collect()
    got = {}
    for row in rows:
        assert row.nodeId not in got.setdefault(row.start, {})
        got[row.start][row.nodeId] = row.hop
    assert got == {start: brute.hops(pairs, [start], 3, back) for start in starts}
