import math
import random
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from brute import TINY
from edgetide.functions.sums import order_free_sum
from edgetide.operators import keys
from edgetide.operators import links as layout
from edgetide.operators.links import prepare_links
from edgetide.operators.rank import rank, rank_edges

GOLDEN = {
    0: dict.fromkeys("ABCDF", 1.0),
    1: {"C": 2.13333333, "F": 1, "B": 0.71666667, "A": 0.575, "E": 0.575},
    2: {"A": 1.05666667, "E": 1.05666667, "F": 1, "C": 0.92208333, "B": 0.47583333},
    10: {"F": 1, "C": 0.60274773, "A": 0.41002311, "E": 0.41002311, "B": 0.38290681},
}


def scores(ranks):
    rows = ranks.collect()
    found = {row.nodeId: row.pagerank for row in rows}
    assert len(found) == len(rows)
    return found


def close(found, expected, tolerance=1e-9):
    assert found == pytest.approx(expected, abs=tolerance)


@pytest.mark.parametrize("iterations", GOLDEN)
def test_tiny(tiny, iterations):
    close(scores(rank_edges(tiny, iterations)), GOLDEN[iterations], 5e-9)


def test_scores_sum_to_node_count_without_sinks(make_edges):
    ring = [(f"{i}", f"{(i * k + 1) % 30}") for i in range(30) for k in (1, 7)]
    found = scores(rank_edges(make_edges(ring)))
    assert sum(found.values()) == pytest.approx(30)


def test_acyclic_graph_empties(make_edges):
    chain = make_edges([("a", "b"), ("b", "c"), ("a", "c")])
    assert set(scores(rank_edges(chain, 2))) == {"c"}
    assert scores(rank_edges(chain, 3)) == {}
    assert scores(rank_edges(chain)) == {}


def test_no_edges(make_edges):
    assert scores(rank_edges(make_edges([]))) == {}


def test_order_and_partitioning_do_not_matter(make_edges):
    edges = brute.random_edges(40, 300, seed=3)
    close(
        scores(rank_edges(make_edges(edges[::-1]).repartition(13))),
        scores(rank_edges(make_edges(edges).coalesce(1))),
    )


def test_partition_count_changes_no_bit(make_edges, monkeypatch):
    edges = brute.random_edges(200, 6000, seed=41)
    found = []
    for partitions in (1, 3, 8):
        monkeypatch.setattr(layout, "partitions_for", lambda *_, n=partitions: n)
        found.append(scores(rank_edges(make_edges(edges).repartition(partitions + 4))))
    assert found[0] == found[1] == found[2]


@pytest.mark.parametrize("size", [1.0, 1e-13, 1e7])
def test_a_sum_is_rounded_once_in_any_order(spark, size):
    rng = random.Random(42)
    values = [size * rng.random() ** rng.randrange(1, 9) for _ in range(3000)]
    expected = math.fsum(values)
    for partitions in (1, 7, 16):
        rng.shuffle(values)
        rows = spark.createDataFrame([(x,) for x in values], "x double").repartition(partitions)
        assert rows.agg(order_free_sum(F.col("x"))).first()[0] == expected


def test_doubled_edges_change_nothing(make_edges):
    edges = brute.random_edges(40, 300, seed=4)
    doubled = scores(rank_edges(make_edges(edges + edges)))
    close(doubled, scores(rank_edges(make_edges(edges))))


def test_counted_edges_equal_plain_ones(spark, tiny):
    counted = spark.createDataFrame(
        [("A", "B", 1), ("A", "B", 1), ("A", "C", 1), ("B", "C", 3), ("C", "A", 2)]
        + [("D", "C", 1), ("C", "E", 2), ("F", "F", 7)],
        "src string, dst string, copies bigint",
    )
    close(scores(rank_edges(counted)), scores(rank_edges(tiny)))


def test_number_ids_become_text(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 2)], "src bigint, dst bigint")
    assert set(scores(rank_edges(edges, 2))) == {"1", "2"}


def test_extreme_damping(tiny):
    assert set(scores(rank_edges(tiny, damping=0)).values()) == {1.0}
    close(scores(rank_edges(tiny, 4, 1)), brute.ranks(TINY, 4, 1.0))


def test_many_rounds(tiny):
    close(scores(rank_edges(tiny, 40)), brute.ranks(TINY, 40, 0.85))


@pytest.mark.parametrize("every", [1, 3, 100])
def test_cutting_the_plan_changes_nothing(tiny, every):
    links = prepare_links(tiny)
    close(scores(rank(links, 7, checkpoint_every=every)), brute.ranks(TINY, 7, 0.85))
    links.release()


@pytest.mark.parametrize("rows_per_slice", [1, 5, 50])
def test_hot_sources_are_spread(make_edges, rows_per_slice):
    edges = brute.random_edges(200, 1500, seed=5)
    links = prepare_links(make_edges(edges), rows_per_slice)
    hot = {row.src0: row.fanout for row in links.hot.collect()}
    assert hot and all(fanout > rows_per_slice for fanout in hot.values())
    spread = {row.src0: row["count"] for row in links.spread.groupBy("src0").count().collect()}
    assert spread == hot
    usual = links.edges.groupBy("src0").count().collect()
    assert not {row.src0 for row in usual} & set(hot)
    assert all(row["count"] <= rows_per_slice for row in usual)
    close(scores(rank(links, 6)), brute.ranks(edges, 6, 0.85))
    links.release()


def test_later_rounds_leave_out_sources_that_receive_nothing(make_edges):
    edges = [(f"s{i}", f"t{i % 3}") for i in range(40)] + [("t0", "t1"), ("t1", "t0"), ("t1", "t2")]
    links = prepare_links(make_edges(edges), rows_per_slice=20)
    assert links.edges.count() == 43 and links.later.count() == 3
    close(scores(rank(links, 6)), brute.ranks(edges, 6, 0.85))
    links.release()


@pytest.mark.parametrize("iterations", [1, 2, 7])
def test_few_later_links_lie_in_few_partitions(make_edges, monkeypatch, iterations):
    monkeypatch.setattr(layout, "FEW_ROWS", 100)
    edges = [(f"s{i}", f"t{i % 9}") for i in range(700)] + [(f"t{i}", f"t{i // 2}") for i in range(9)]
    links = prepare_links(make_edges(edges), rows_per_slice=500)
    monkeypatch.setattr(layout, "FEW_ROWS", 1000)
    later, partitions = layout.later_edges(
        links.edges, links.sources, links.nodes, links.keys, links.partitions
    )
    assert (links.partitions, partitions) == (8, 1)
    moved = replace(links, later=later, later_partitions=partitions)
    close(scores(rank(moved, iterations)), brute.ranks(edges, iterations, 0.85))
    moved.release()
    links.release()


@pytest.mark.parametrize("every", [0, -1])
def test_the_plan_must_be_cut_at_some_time(tiny, every):
    links = prepare_links(tiny)
    with pytest.raises(ValueError, match="checkpoint_every"):
        rank(links, 2, checkpoint_every=every)
    links.release()


def test_clashing_keys_are_told_apart(make_edges, monkeypatch):
    edges = brute.random_edges(60, 400, seed=6)
    expected = brute.ranks(edges, 5, 0.85)
    real = keys._hashes

    def weak(node):
        first, second = real(node)
        return [first % 7, second]

    monkeypatch.setattr(keys, "_hashes", weak)
    links = prepare_links(make_edges(edges))
    assert links.keys.hashes == 2
    close(scores(rank(links, 5)), expected)
    monkeypatch.setattr(keys, "_hashes", lambda node: [column % 3 for column in real(node)])
    links = prepare_links(make_edges(edges), rows_per_slice=10)
    assert links.keys.hashes == 0
    close(scores(rank(links, 5)), expected)


@pytest.mark.parametrize("iterations,damping", [(-1, 0.85), (2.5, 0.85), (True, 0.85)])
def test_bad_iterations(tiny, iterations, damping):
    with pytest.raises(ValueError, match="iterations"):
        rank_edges(tiny, iterations, damping)


@pytest.mark.parametrize("damping", [-0.1, 1.1])
def test_bad_damping(tiny, damping):
    with pytest.raises(ValueError, match="damping"):
        rank_edges(tiny, 1, damping)


node = st.sampled_from("abcdefgh")


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    edges=st.lists(st.tuples(node, node), min_size=1, max_size=30),
    iterations=st.integers(0, 4),
    damping=st.sampled_from([0.0, 0.5, 0.85, 1.0]),
)
def test_any_small_graph(make_edges, edges, iterations, damping):
    found = scores(rank_edges(make_edges(edges), iterations, damping))
    close(found, brute.ranks(edges, iterations, damping))
