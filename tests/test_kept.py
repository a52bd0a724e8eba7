"""Layouts and rounds that are kept between jobs."""

import pytest

import brute
from edgetide.operators import links as layout
from edgetide.operators import rank as module
from edgetide.operators.links import fixed_layout, prepare_links
from edgetide.operators.rank import initial_ranks, next_ranks, rank
from edgetide.operators.stats import store_counted
from edgetide.plans.job import forget_kept, rerun_job, run_job
from edgetide.sources.layout import fingerprint, open_links, save_links
from edgetide.sources.results import drop_versions, read_results
from edgetide.sources.rounds import Rounds
from edgetide.storage import checkpoint


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def rounds_done(monkeypatch):
    """Counts the rounds that are computed; ``limit`` makes the one after it fail."""

    class Counter:
        done, limit = 0, None

    usual = next_ranks

    def counted(*args):
        if Counter.done == Counter.limit:
            raise RuntimeError("lost")
        Counter.done += 1
        return usual(*args)

    monkeypatch.setattr(module, "next_ranks", counted)
    return Counter


@pytest.fixture
def more_partitions(monkeypatch):
    monkeypatch.setattr(layout, "FEW_ROWS", 10)


def scores(ranks):
    return {row.nodeId: row.pagerank for row in ranks.collect()}


def test_more_rounds_go_on_from_kept_ones(spark, make_edges, tmp_path, rounds_done):
    pairs = brute.random_edges(60, 400, seed=21)
    out = str(tmp_path / "out")
    run_job(make_edges(pairs), out, "random", iterations=10, keep=True)
    assert rounds_done.done == 10
    version = rerun_job(spark, out, iterations=15)
    assert rounds_done.done == 15
    saved = read_results(spark, out)
    assert saved.version == version and saved.metadata.first().dataset_name == "random"
    assert scores(saved.ranking) == pytest.approx(brute.ranks(pairs, 15, 0.85), abs=1e-10)
    # fewer rounds are read, other damping or edges start anew
    run_job(make_edges(pairs), out, "random", iterations=5, keep=True)
    assert rounds_done.done == 15
    assert scores(read_results(spark, out).ranking) == pytest.approx(
        brute.ranks(pairs, 5, 0.85), abs=1e-10
    )
    rerun_job(spark, out, iterations=2, damping=0.5)
    run_job(make_edges(pairs + pairs[:1]), out, "more", iterations=1, keep=True)
    assert rounds_done.done == 18
    forget_kept(spark, out)
    assert not (tmp_path / "out" / "kept").exists()
    assert read_results(spark, out).metadata.first().dataset_name == "more"


def test_a_rerun_shares_lists_and_index(spark, make_edges, tmp_path):
    pairs = brute.random_edges(60, 400, seed=23)
    out = str(tmp_path)
    first = run_job(make_edges(pairs), out, "random", iterations=3, keep=True)
    again = rerun_job(spark, out, iterations=4)
    assert not (tmp_path / f"version={again}" / "index").exists()
    before, after = (read_results(spark, out, version) for version in (first, again))
    for old, new in ((before.graph, after.graph), (before.incoming.rows, after.incoming.rows)):
        assert sorted(old.collect()) == sorted(new.collect())
    # what a kept version refers to stays, another limit is written anew
    drop_versions(spark, out, 1)
    last = rerun_job(spark, out, iterations=4, entries_per_list=5)
    assert max(len(row.neighbors) for row in read_results(spark, out).graph.collect()) == 5
    assert (tmp_path / f"version={first}").exists() and not read_results(spark, out, again).graph.isEmpty()
    drop_versions(spark, out, 1)
    assert [path.name for path in tmp_path.glob("version=*")] == [f"version={last}"]


def test_a_job_killed_in_a_round_goes_on_from_the_last_cut(
    spark, make_edges, tmp_path, rounds_done
):
    pairs = brute.random_edges(60, 400, seed=22)
    out, edges = str(tmp_path / "out"), make_edges(pairs)
    rounds_done.limit = 6
    with pytest.raises(RuntimeError, match="lost"):
        run_job(edges, out, "random", iterations=10, keep=True)
    rounds_done.limit = None
    run_job(edges, out, "random", iterations=10, keep=True)
    assert rounds_done.done == 6 + 5
    got = scores(read_results(spark, out).ranking)
    assert got == pytest.approx(brute.ranks(pairs, 10, 0.85), abs=1e-10)


def test_an_unfinished_round_does_not_count(spark, make_edges, tmp_path):
    links = prepare_links(make_edges(brute.TINY))
    rounds = Rounds(spark, str(tmp_path), 0.85)
    rank(links, 5, rounds=rounds)
    assert rounds.kept() == [5] and rounds.last(4) is None and rounds.last(9) == 5
    (tmp_path / "damping=0.85" / "round=5" / "_SUCCESS").unlink()
    assert rounds.kept() == [] and Rounds(spark, str(tmp_path), 0.9).kept() == []
    links.release()


@pytest.mark.parametrize("slice_rows", [None, 5])
def test_a_saved_layout_is_joined_without_a_shuffle(
    spark, make_edges, tmp_path, more_partitions, slice_rows
):
    pairs = brute.random_edges(100, 900, seed=23)
    links = prepare_links(make_edges(pairs), rows_per_slice=slice_rows)
    save_links(links, str(tmp_path / "g"))
    links.release()
    opened = open_links(spark, str(tmp_path / "g"))
    assert opened.partitions == 8 and (opened.hot is not None) == bool(slice_rows)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        with fixed_layout(spark, opened.partitions):
            assert "Exchange" not in plan_of(opened.edges)
            ranks = checkpoint(next_ranks(opened, initial_ranks(opened)))
            once = next_ranks(opened, ranks)
            # the one shuffle is that of the sums
            assert plan_of(once).count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set(threshold, before)
    got = scores(rank(opened, 10))
    assert got == pytest.approx(brute.ranks(pairs, 10, 0.85), abs=1e-10)
    sizes = opened.sizes().first()
    assert sizes.total_edges == 900
    names = opened.tables
    opened.release()
    assert not any(spark.catalog.tableExists(name) for name in names)


def test_an_unfinished_layout_is_written_again(spark, make_edges, tmp_path):
    links = prepare_links(make_edges(brute.TINY))
    folder = str(tmp_path / "it's")
    assert open_links(spark, folder) is None
    save_links(links, folder)
    (tmp_path / "it's" / "description" / "_SUCCESS").unlink()
    assert open_links(spark, folder) is None
    save_links(links, folder)
    links.release()
    again = open_links(spark, folder)
    assert scores(rank(again, 3)) == pytest.approx(brute.ranks(brute.TINY, 3, 0.85), abs=1e-12)
    again.release()


def test_fingerprint_is_of_the_multiset(make_edges):
    def mark(pairs):
        return fingerprint(store_counted(make_edges(pairs))[0])

    pairs = brute.random_edges(30, 100, seed=24)
    assert mark(pairs) == mark(pairs[::-1])
    assert len({mark(pairs), mark(pairs[1:]), mark([*pairs, pairs[0]]), mark([])} | {
        mark([(b, a) for a, b in pairs])}) == 5
