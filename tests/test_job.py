import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import brute
from brute import TINY
from edgetide.operators import lookup
from edgetide.operators.topk import full_ranking
from edgetide.plans import job
from edgetide.plans.job import run_job
from edgetide.sources.results import ResultsNotReady, read_ranking, read_results
from edgetide.streaming.refresh import refresh_from_stream


def saved_scores(results):
    return {row.nodeId: row.pagerank for row in results.ranking.collect()}


def test_round_trip(spark, tiny, tmp_path):
    out = str(tmp_path / "out")
    version = run_job(tiny, out, "tiny", completed_at="then")
    saved = read_results(spark, out)
    assert saved.version == version
    assert [tuple(row) for row in saved.top.orderBy("rank").collect()] == [
        (1, "F", 1.0),
        (2, "C", 0.60274773),
        (3, "A", 0.41002311),
        (4, "E", 0.41002311),
        (5, "B", 0.38290681),
    ]
    assert {row.nodeId: row.pagerank for row in saved.stored.collect()}["B"] == 0.38290681
    assert saved_scores(saved) == pytest.approx(brute.ranks(TINY, 10, 0.85), abs=1e-10)
    assert {r.nodeId: r.neighbors for r in saved.graph.collect()}["A"] == ["B", "B", "C"]
    assert saved.metadata.first().asDict() == {
        "dataset_name": "tiny",
        "total_nodes": 6,
        "total_edges": 8,
        "iterations": 10,
        "damping_factor": 0.85,
        "top_node": "F",
        "completed_at": "then",
    }


def test_files_hold_the_documented_forms(spark, tiny, tmp_path):
    version = run_job(tiny, str(tmp_path), "tiny", completed_at="then")
    folder = tmp_path / f"version={version}"

    def lines(name):
        parts = sorted((folder / name).glob("part-*"))
        return [line for part in parts for line in part.read_text().splitlines()]

    assert lines("ranking")[0] == "F\t1.0000000000"
    assert [line.split("\t")[0] for line in lines("ranking")] == list("FCAEB")
    assert json.loads(lines("top")[0]) == {"rank": 1, "nodeId": "F", "pagerank": 1.0}
    assert json.loads(lines("stored")[1]) == {"nodeId": "C", "pagerank": 0.60274773}
    assert json.loads(lines("metadata")[0])["total_edges"] == 8


def test_empty_ranking_is_saved(spark, make_edges, tmp_path):
    run_job(make_edges([("a", "b")]), str(tmp_path), "one edge")
    saved = read_results(spark, str(tmp_path))
    assert saved.ranking.collect() == [] and saved.top.collect() == []
    row = saved.metadata.first()
    assert (row.total_nodes, row.total_edges, row.top_node) == (2, 1, None)


def test_readers_see_the_last_finished_version(spark, tiny, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    with pytest.raises(ResultsNotReady):
        read_results(spark, out)

    def broken(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(job, "write_metadata", broken)
        with pytest.raises(RuntimeError, match="lost"):
            run_job(tiny, out, "tiny")
    with pytest.raises(ResultsNotReady):
        read_results(spark, out)

    first = run_job(tiny, out, "tiny", iterations=1)
    with monkeypatch.context() as patch:
        patch.setattr(job, "write_metadata", broken)
        with pytest.raises(RuntimeError):
            run_job(tiny, out, "tiny")
    assert read_results(spark, out).version == first
    second = run_job(tiny, out, "tiny", iterations=2, damping=0.5)
    assert second > first
    newest = read_results(spark, out)
    assert saved_scores(newest) == pytest.approx(brute.ranks(TINY, 2, 0.5), abs=1e-10)
    row = newest.metadata.first()
    assert (row.iterations, row.damping_factor) == (2, 0.5)
    older = read_results(spark, out, first)
    assert saved_scores(older) == pytest.approx(brute.ranks(TINY, 1, 0.85), abs=1e-10)


def test_bad_parameters_write_nothing(tiny, tmp_path):
    with pytest.raises(ValueError):
        run_job(tiny, str(tmp_path / "out"), "tiny", iterations=-1)
    assert not (tmp_path / "out").exists()


ODD = ["a\tb", "c\nd", "e\r", "x\u0085y", "\u2028", "", " ", "\\n"]


def test_every_id_survives(spark, make_edges, tmp_path):
    version = run_job(make_edges([(node, node) for node in ODD]), str(tmp_path), "odd ids")
    saved = read_results(spark, str(tmp_path))
    assert saved_scores(saved) == {node: 1.0 for node in ODD}
    assert sorted(row.nodeId for row in saved.stored.collect()) == sorted(ODD)
    for node in ODD:
        assert lookup.neighbors(saved.outgoing, node).first().neighbors == [node]
    lines = read_ranking(spark, f"{tmp_path}/version={version}/ranking").collect()
    escaped = [node.replace("\n", "\\n").replace("\r", "\\r") for node in ODD]
    assert sorted(row.nodeId for row in lines) == sorted(escaped)


@pytest.mark.parametrize("edge", [("a", None), (None, "b")])
def test_null_ids_are_refused(spark, edge, tmp_path):
    edges = spark.createDataFrame([("a", "b"), edge], "src string, dst string")
    with pytest.raises(PySparkException, match="edge without"):
        run_job(edges, str(tmp_path), "holes")


def test_saved_lookups_read_the_sorted_copies(spark, tiny, tmp_path):
    run_job(tiny, str(tmp_path), "tiny")
    saved = read_results(spark, str(tmp_path))
    assert lookup.neighbors(saved.outgoing, "A").first().neighbors == ["B", "B", "C"]
    assert lookup.influenced_by(saved.incoming, "C").first().sources == ["A", "B", "D"]
    for edges, column in ((saved.outgoing, "src"), (saved.incoming, "dst")):
        plan = edges.where(F.col(column) == "A").rows._jdf.queryExecution().executedPlan()
        assert f"EqualTo({column},A)" in plan.toString()


def test_the_job_reads_its_input_once_and_counts_once(spark, tmp_path):
    """Rows of the input that the whole job looks at, counted as they pass."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    pairs = brute.random_edges(40, 300, seed=3)
    edges = spark.createDataFrame(pairs, "src string, dst string")
    run_job(edges.mapInArrow(count, "src string, dst string"), str(tmp_path), "counted")
    assert seen.value == 300


def test_a_long_list_is_cut_as_told(spark, make_edges, tmp_path):
    edges = make_edges([("hub", f"n{i:03}") for i in range(95)])
    run_job(edges, str(tmp_path), "hub", entries_per_list=10)
    rows = read_results(spark, str(tmp_path)).graph.orderBy("part").collect()
    assert [len(row.neighbors) for row in rows] == [10] * 9 + [5]
    assert [x for row in rows for x in row.neighbors] == [f"n{i:03}" for i in range(95)]


def refresh(spark, folder, **options):
    refresh_from_stream(
        spark,
        str(folder / "in"),
        str(folder / "store"),
        str(folder / "out"),
        "arriving",
        every=None,
        **options,
    ).awaitTermination()
    return read_results(spark, str(folder / "out"))


def test_refresh_adds_files_as_they_come(spark, tmp_path):
    def put(name, edges):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("".join(f"{a}\t{b}\n" for a, b in edges))

    put("1.txt", TINY[:3])
    first = refresh(spark, tmp_path)
    assert saved_scores(first) == pytest.approx(brute.ranks(TINY[:3], 10, 0.85), abs=1e-10)
    put("2.txt", TINY[3:6])
    put("3.txt", TINY[6:])
    second = refresh(spark, tmp_path, files_per_trigger=1)
    assert saved_scores(second) == pytest.approx(brute.ranks(TINY, 10, 0.85), abs=1e-10)
    assert second.metadata.first().total_edges == 8
    assert sorted(p.name for p in (tmp_path / "store").glob("batch=*")) == [
        "batch=0",
        "batch=1",
        "batch=2",
    ]
    assert refresh(spark, tmp_path).version == second.version


def test_batches_are_merged_and_versions_retained(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i, edge in enumerate(TINY):
        (tmp_path / "in" / f"{i}.txt").write_text("\t".join(edge) + "\n")
        saved = refresh(spark, tmp_path, merge_every=3, keep_versions=2)
        assert saved.metadata.first().total_edges == i + 1
    names = sorted(p.name for p in (tmp_path / "store").glob("*=*"))
    assert names == ["batch=3", "batch=4", "batch=5", "batch=6", "batch=7", "upto=2", "upto=5"]
    assert len(list((tmp_path / "out").glob("version=*"))) == 2
    assert saved_scores(saved) == pytest.approx(brute.ranks(TINY, 10, 0.85), abs=1e-10)


def test_a_replayed_batch_counts_once(spark, tmp_path, monkeypatch):
    """The job fails after the batch is stored; the restarted stream gets the batch again."""
    from edgetide.streaming import refresh as module

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("".join(f"{a}\t{b}\n" for a, b in TINY))

    def broken(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(module, "run_job", broken)
        with pytest.raises(PySparkException):
            refresh(spark, tmp_path)
    assert (tmp_path / "store" / "batch=0").exists()
    assert refresh(spark, tmp_path).metadata.first().total_edges == 8


def test_ranking_file_order_is_rank_order(spark, make_edges, tmp_path):
    edges = make_edges(brute.random_edges(300, 2000, seed=11))
    version = run_job(edges, str(tmp_path), "random", iterations=3)
    parts = sorted((tmp_path / f"version={version}" / "ranking").glob("part-*"))
    lines = [line for part in parts for line in part.read_text().splitlines()]
    best_first = full_ranking(read_results(spark, str(tmp_path)).ranking)
    assert [line.split("\t")[0] for line in lines] == [r.nodeId for r in best_first.collect()]
