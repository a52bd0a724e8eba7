import pytest

import brute
from edgetide.operators.incremental import RankHistory
from test_job import refresh, saved_scores


def scores(history, number):
    return {row.nodeId: row.pagerank for row in history.ranks(number).collect()}


@pytest.mark.parametrize("slice_rows", [1_000_000, 5])
def test_every_batch_equals_a_full_run(spark, make_edges, tmp_path, slice_rows):
    pairs = brute.random_edges(80, 300, seed=31)
    history = RankHistory(spark, str(tmp_path), iterations=4, damping=0.8)
    # new nodes, copies of an edge, a sink that becomes a source, nodes that gain their first in-link
    batches = [pairs, [("n1", "new"), ("n1", "new")], [("new", "n0"), ("lone", "lone")],
               [("a", "b")]]
    for number, batch in enumerate(batches):
        history.add(make_edges(batch), number, slice_rows)
        known = [edge for part in batches[: number + 1] for edge in part]
        assert scores(history, number) == pytest.approx(brute.ranks(known, 4, 0.8), abs=1e-12)
    touched = {row["round"]: row for row in history.touched(3).collect()}
    # a stays apart from the rest: it and its target are all that is looked at
    assert [touched[k].recomputed for k in range(5)] == [1, 1, 1, 1, 1]
    assert max(touched[k].edges_read for k in range(5)) == 1
    assert touched[1].nodes > 50


def test_a_small_batch_touches_few_rows(spark, make_edges, tmp_path):
    # a long chain of communities: a change travels one link a round
    pairs = [(f"n{i}", f"n{(i + 1) % 2000}") for i in range(2000)]
    pairs += [(f"n{i}", f"n{i + 2}") for i in range(0, 1900, 5)]
    history = RankHistory(spark, str(tmp_path), iterations=5)
    history.add(make_edges(pairs), 0)
    history.add(make_edges([("n7", "n1500")]), 1)
    assert scores(history, 1) == pytest.approx(
        brute.ranks([*pairs, ("n7", "n1500")], 5, 0.85), abs=1e-12
    )
    full = sum(row.recomputed for row in history.touched(0).collect())
    few = sum(row.recomputed for row in history.touched(1).collect())
    assert few < full / 50


def test_a_state_made_again_is_the_same(spark, make_edges, tmp_path):
    history = RankHistory(spark, str(tmp_path), iterations=3)
    history.add(make_edges(brute.TINY[:5]), 0)
    for _ in range(2):
        history.add(make_edges(brute.TINY[5:]), 1)
        assert scores(history, 1) == pytest.approx(brute.ranks(brute.TINY, 3, 0.85), abs=1e-12)
    assert history.states() == [0, 1]
    history.drop_rounds(0)
    assert history.edges(1).count() == 5 + 3


def test_incremental_refresh_equals_the_full_one(spark, tmp_path):
    pairs = brute.random_edges(40, 150, seed=32)
    (tmp_path / "in").mkdir()
    for i in range(3):
        part = pairs[50 * i : 50 * i + 50]
        (tmp_path / "in" / f"{i}.txt").write_text("".join(f"{a}\t{b}\n" for a, b in part))
    saved = refresh(spark, tmp_path, files_per_trigger=1, incremental=True, iterations=4)
    assert saved_scores(saved) == pytest.approx(brute.ranks(pairs, 4, 0.85), abs=1e-10)
    assert saved.metadata.first().total_edges == 150
    # the newest two states keep their ranks
    rounds = sorted(p.parent.name for p in (tmp_path / "store" / "history").glob("*/round=4"))
    assert rounds == ["state=1", "state=2"]


def test_a_large_batch_is_ranked_in_the_layout_of_a_full_run(spark, make_edges, tmp_path):
    # a third of the edges, some of them copies of earlier ones, and a narrow batch on what it left
    pairs = brute.random_edges(80, 300, seed=33)
    batches = [pairs[:200], pairs[200:] + pairs[:20], [("n1", "n2")]]
    history = RankHistory(spark, str(tmp_path), iterations=4)
    for number, batch in enumerate(batches):
        history.add(make_edges(batch), number)
        known = [edge for part in batches[: number + 1] for edge in part]
        assert scores(history, number) == pytest.approx(brute.ranks(known, 4, 0.85), abs=1e-12)
    touched = {row["round"]: row for row in history.touched(1).collect()}
    assert touched[1].edges_read == len(set(pairs))
    assert touched[1].recomputed == touched[1].nodes
