import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from edgetide.llm.sharding import schedule, shard_documents


def greedy(sizes, shards):
    """The loads after each group, largest first, went to the least-loaded shard."""
    loads = [0] * shards
    for size in sorted(sizes, reverse=True):
        loads[loads.index(min(loads))] += size
    return loads


def runs_of(sizes):
    return sorted(Counter(sizes).items(), reverse=True)


@pytest.mark.parametrize("shards", [1, 2, 3, 16])
def test_runs_are_scheduled_like_single_groups(shards):
    rng = random.Random(shards)
    for _ in range(60):
        sizes = []
        for _ in range(rng.randint(0, 8)):
            sizes += [rng.randint(0, rng.choice([3, 50, 4000]))] * rng.choice([1, 5, 70, 900])
        loads = [0] * shards
        for (size, groups), taken in zip(runs_of(sizes), schedule(runs_of(sizes), shards)):
            assert sum(taken) == groups and min(taken) >= 0
            loads = [load + size * n for load, n in zip(loads, taken)]
        assert loads == greedy(sizes, shards)


def test_a_billion_equal_groups_take_one_step():
    (taken,) = schedule([(7, 10**9)], 16)
    assert taken == [10**9 // 16] * 16


def test_100_000_small_groups_are_the_greedy_schedule(spark):
    docs = spark.range(100_000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.col("id").cast("string"), F.expr("repeat('x', int(id % 300))")).alias("text"),
    )
    docs = docs.unionAll(docs.where("doc_id % 3 = 0")).unionAll(
        spark.range(50_000).select("id", F.lit("a copy"))
    )
    rows = shard_documents(docs, 16).groupBy("text_crc32", "size", "shard").count().collect()
    sizes = Counter()
    for row in docs.groupBy("text").count().collect():
        sizes[row.text] += row["count"] * (len(row.text) + 1)
    loads = Counter()
    for row in rows:
        loads[row.shard] += row["size"] * row["count"]
    assert [loads[shard] for shard in range(16)] == greedy(sizes.values(), 16)


def check(rows, texts, shards):
    assert len(rows) == len(texts)
    by_text = {}
    for row in rows:
        text = texts[row.doc_id]
        raw = (text or "").encode()
        assert (row.size, row.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        by_text.setdefault(text, set()).add(row.shard)
    assert all(len(found) == 1 for found in by_text.values())
    for shard in range(shards):
        slots = sorted(row.slot for row in rows if row.shard == shard)
        assert slots == list(range(len(slots)))
    assert {row.shard for row in rows} <= set(range(shards))


def test_groups_stay_and_slots_have_no_gap(make_docs, odd_texts, crowded):
    rows = shard_documents(crowded(make_docs(odd_texts)), 4).collect()
    check(rows, odd_texts, 4)


def test_loads_are_near_equal(make_docs):
    texts = [f"text {i} " + "x" * (i * 37 % 500) for i in range(1500)]
    rows = shard_documents(make_docs(texts), 8).collect()
    check(rows, texts, 8)
    loads = [sum(row.size for row in rows if row.shard == shard) for shard in range(8)]
    assert max(loads) - min(loads) <= 0.1 * sum(loads) / 8


def test_repeated_rows_and_ids_and_no_rows(make_docs):
    docs = make_docs(["a", "a", "b", None], ids=[1, 1, 1, None])
    rows = shard_documents(docs, 2).collect()
    assert len(rows) == 4
    for shard in (0, 1):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(
            range(sum(r.shard == shard for r in rows))
        )
    assert shard_documents(docs.limit(0), 2).collect() == []
