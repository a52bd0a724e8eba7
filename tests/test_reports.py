import pytest
from pyspark.sql import functions as F

from edgetide.operators import lookup, topk
from edgetide.schema import METADATA


@pytest.fixture(scope="module")
def ranks(spark):
    rows = [(f"n{i:04d}", 2000.0 - i // 2 + 1e-10 * (i % 2)) for i in range(1200)]
    rows += [("tie b", 5000.0), ("tie a", 5000.0)]
    return spark.createDataFrame(rows, "nodeId string, pagerank double")


def test_top_list_orders_and_numbers(ranks):
    rows = [tuple(row) for row in topk.top_list(ranks).collect()]
    assert rows == [
        (1, "tie a", 5000.0),
        (2, "tie b", 5000.0),
        # the better one by 1e-10: sorted first, rounded after
        (3, "n0001", 2000.0),
        (4, "n0000", 2000.0),
        (5, "n0003", 1999.0),
    ]


def test_full_ranking_and_lines(ranks):
    full = topk.full_ranking(ranks).collect()
    assert len(full) == 1202 and full[-1].nodeId == "n1198"
    lines = [row.value for row in topk.ranking_lines(ranks).collect()]
    assert lines[0] == "tie a\t5000.0000000000" and lines[2] == "n0001\t2000.0000000001"


def test_top_n(ranks):
    stored = topk.stored_list(ranks)
    assert stored.count() == 1000
    assert [row.nodeId for row in topk.top_n(stored, "2").collect()] == ["tie a", "tie b"]
    # equal once rounded: the place decides
    assert [row.nodeId for row in topk.top_n(stored, 3).collect()][2:] == ["n0001"]
    assert topk.top_n(stored, 5000).count() == topk.top_n(stored, 10**10).count() == 1000
    assert topk.stored_list(ranks, 10**10).count() == 1202
    assert tuple(topk.top_n_header(stored, 10).first()) == (10, 10, None)
    assert tuple(topk.top_n_header(stored, 1000).first()) == (1000, 1000, None)
    note = "all 1000 stored nodes are listed"
    assert tuple(topk.top_n_header(stored, 5000).first()) == (5000, 1000, note)


@pytest.mark.parametrize("n,message", [("x", "integer"), (2.5, "integer"), (0, "1"), (-3, "1")])
def test_bad_n(ranks, n, message):
    for report in (topk.top_n, topk.top_n_header):
        with pytest.raises(ValueError, match=message):
            report(topk.stored_list(ranks), n)


def test_node_score_sees_the_stored_nodes_only(spark, ranks):
    assert lookup.node_score(ranks, "tie b").first().pagerank == 5000.0
    assert lookup.node_score(ranks, "n1100").collect() == []
    assert lookup.node_score(ranks, "n1100", stored=None).count() == 1
    assert lookup.node_score(ranks, "nobody", stored=None).collect() == []
    wanted = spark.createDataFrame([("tie a",), ("n1100",), ("tie a",)], "nodeId string")
    best = lookup.node_scores(ranks, wanted, stored=1000)
    assert [r.nodeId for r in best.collect()] == ["tie a"]
    assert lookup.node_scores(ranks, wanted).count() == 2
    everything = ranks.select("nodeId")
    assert lookup.node_scores(ranks, everything).count() == 1202


def test_stats_defaults(spark):
    empty = spark.createDataFrame([(None,) * len(METADATA)], METADATA)
    assert tuple(lookup.job_stats(empty).first()) == ("unknown", 0, 0, 0, 0.0, "", "")


def test_exact_rounding_half_to_even(spark):
    import random

    from edgetide.functions.text import rounded, ten_decimals

    rng = random.Random(7)
    values = [0.0, 0.15, 0.5**9, 0.5**10, 3 * 0.5**9, 1 - 2**-53, 2.0**26 - 0.5**9, 2.0**26,
              445.717785975, 0.999999995, 0.99999999995, 1e15 + 0.5]
    for _ in range(3000):
        values.append(sum(0.5 ** rng.randint(1, 40) for _ in range(rng.randint(1, 5))))
        values.append((rng.randrange(10**10) + 0.5) / 10 ** rng.choice((8, 10)))
        values.append(rng.random() * 10 ** rng.randint(-3, 7))
    x = F.col("x")
    df = spark.createDataFrame([(value,) for value in values], "x double")
    rows = df.select("x", rounded(x).alias("eight"), ten_decimals(x).alias("ten")).collect()
    assert [(row.eight, row.ten) for row in rows] == [(round(v, 8), "%.10f" % v) for v in values]
    # the shortest text rounded half up differs
    assert sum(row.old != round(row.x, 8) for row in df.select("x", F.round(x, 8).alias("old")).collect())
    none = spark.createDataFrame([(None,)], "x double")
    assert none.select(rounded(x).alias("a"), ten_decimals(x).alias("b")).first() == (None, None)


def test_long_lists_are_numbered_by_ranges(spark, monkeypatch):
    ranks = spark.range(1000).select(
        F.concat(F.lit("n"), "id").alias("nodeId"), (F.col("id") % 37 / 7.0).alias("pagerank")
    )
    usual = sorted(map(tuple, topk.top_list(ranks, 600).collect()))
    monkeypatch.setattr(topk, "IN_ONE_TASK", 10)
    by_ranges = topk.top_list(ranks, 600)
    assert sorted(map(tuple, by_ranges.collect())) == usual
    assert "Window [row_number" not in by_ranges._jdf.queryExecution().executedPlan().toString()
    places = topk.all_places(ranks).collect()
    assert sorted(row.rank for row in places) == list(range(1, 1001))
