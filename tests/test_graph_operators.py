from collections import Counter, defaultdict

import pytest

import brute
from brute import TINY
from edgetide.operators import adjacency, lookup, skew, stats
from edgetide.operators.trace import trace


def ids(df):
    return sorted(row.nodeId for row in df.collect())


def test_stats(tiny, make_edges):
    row = stats.graph_stats(tiny).first()
    assert (row.total_edges, row.total_nodes, row.source_nodes) == (8, 6, 5)
    assert tuple(stats.graph_stats(make_edges([])).first()) == (0, 0, 0)
    assert ids(stats.nodes(tiny)) == list("ABCDEF")
    assert ids(stats.sink_nodes(tiny)) == ["E"]
    assert ids(stats.no_inlink_nodes(tiny)) == ["D"]
    assert dict(stats.out_degree(tiny).collect()) == dict(A=3, B=1, C=2, D=1, F=1)
    assert dict(stats.in_degree(tiny).collect()) == dict(A=1, B=2, C=3, E=1, F=1)


def joined(df, name):
    lists = defaultdict(list)
    for row in df.collect():
        lists[row.nodeId] += row[name]
    return {node: sorted(entries) for node, entries in lists.items()}


def expected_lists(edges, back=False):
    lists = defaultdict(list)
    for src, dst in edges:
        lists[dst if back else src].append(src if back else dst)
    return {node: sorted(entries) for node, entries in lists.items()}


def test_adjacency(tiny):
    rows = adjacency.adjacency(tiny).collect()
    assert {r.nodeId: (r.part, r.neighbors) for r in rows} == {
        "A": (0, ["B", "B", "C"]),
        "B": (0, ["C"]),
        "C": (0, ["A", "E"]),
        "D": (0, ["C"]),
        "F": (0, ["F"]),
    }
    assert joined(adjacency.reverse_adjacency(tiny), "sources") == expected_lists(TINY, True)


@pytest.mark.parametrize("small", [False, True])
def test_long_lists_come_in_parts(make_edges, monkeypatch, small):
    """Hub, and one edge with more copies than a list may hold; both join paths."""
    if small:
        monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(skew, "MAX_HOT", 1)
    edges = brute.random_edges(50, 400, seed=8) + [("n1", "n2")] * 95
    df = make_edges(edges)
    rows = adjacency.adjacency(df, limit=10).collect()
    assert len({(row.nodeId, row.part) for row in rows}) == len(rows)
    assert max(len(row.neighbors) for row in rows) == 10
    for node, entries in expected_lists(edges).items():
        parts = sorted((row.part, row.neighbors) for row in rows if row.nodeId == node)
        assert [part for part, _ in parts] == list(range(len(parts)))
        assert [entry for _, held in parts for entry in held] == entries
    assert joined(adjacency.adjacency(df, limit=10), "neighbors") == expected_lists(edges)
    assert joined(adjacency.reverse_adjacency(df, limit=10), "sources") == expected_lists(
        edges, True
    )


def test_neighbors(tiny):
    row = lookup.neighbors(tiny, "A").first()
    assert tuple(row) == ("A", "outgoing", 3, 0, ["B", "B", "C"])
    row = lookup.influenced_by(tiny, "C").first()
    assert tuple(row) == ("C", "incoming", 3, 0, ["A", "B", "D"])
    assert lookup.neighbors(tiny, "E").collect() == []
    assert lookup.influenced_by(tiny, "D").collect() == []
    assert lookup.neighbors(tiny, "nobody").collect() == []


def test_neighbor_count_covers_all_parts(make_edges):
    df = make_edges([("hub", f"{i}") for i in range(100)])
    rows = lookup.neighbors(df, "hub", limit=10).collect()
    assert len(rows) == 10 and {row["count"] for row in rows} == {100}
    assert sum(len(row.neighbors) for row in rows) == 100


@pytest.mark.parametrize("direction", ["outgoing", "incoming"])
@pytest.mark.parametrize("small", [False, True])
def test_neighbors_of_many(spark, make_edges, monkeypatch, direction, small):
    if small:
        monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    edges = brute.random_edges(50, 400, seed=9)
    wanted = [f"n{i}" for i in range(0, 60, 3)] + ["n0", "n0"]
    frame = spark.createDataFrame([(node,) for node in wanted], "nodeId string")
    found = lookup.neighbors_of(make_edges(edges), frame, direction, rows_per_slice=20)
    name = "neighbors" if direction == "outgoing" else "sources"
    everything = expected_lists(edges, direction == "incoming")
    assert joined(found, name) == {n: everything[n] for n in wanted if n in everything}


@pytest.mark.parametrize("back", [False, True])
@pytest.mark.parametrize("small", [False, True])
def test_trace(spark, make_edges, monkeypatch, back, small):
    if small:
        monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    edges = brute.random_edges(300, 500, seed=10, hub_share=20)
    starts = ["n7", "n0", "n7"]
    frame = spark.createDataFrame([(node,) for node in starts], "nodeId string")
    found = trace(make_edges(edges), frame, 4, back, rows_per_slice=10)
    rows = [tuple(row) for row in found.collect()]
    assert Counter(node for node, _ in rows).most_common(1)[0][1] == 1
    assert dict(rows) == brute.hops(edges, starts, 4, back)


def test_a_negative_number_of_hops_is_refused(make_edges, spark):
    start = spark.createDataFrame([("a",)], "nodeId string")
    with pytest.raises(ValueError, match="hops"):
        trace(make_edges([("a", "b")]), start, -1)


def test_trace_stops_on_cycles_and_ends(make_edges, spark):
    ring = make_edges([("a", "b"), ("b", "c"), ("c", "a")])
    start = spark.createDataFrame([("a",)], "nodeId string")
    assert dict(trace(ring, start, 50).collect()) == {"a": 0, "b": 1, "c": 2}
    assert dict(trace(ring, start, 0).collect()) == {"a": 0}
