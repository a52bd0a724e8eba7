"""Shards by longest-processing-time scheduling.

Documents of equal text form a group that stays together. Groups sorted by size go, largest
first, to the shard with the least load, which a heap yields. Groups of equal size are
interchangeable, so the schedule is made on runs of equal sizes: for each, how many groups every
shard takes. A group then finds its shard by its rank among those of its size. The driver holds
one row for each distinct size; as they add up to at most all bytes, there are fewer than
sqrt(2 * bytes) of them however many documents there are.
"""

import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgetide.llm.common import buckets_for, number_within, utf8_crc32
from edgetide.operators.skew import BROADCAST_BYTES, ROWS_PER_SLICE, hot_keys, join_unique
from edgetide.storage import store


def _level(loads: list[int], amount: int) -> int:
    """The height to which ``amount`` fills the rising ``loads``, rounded down."""
    filled = 0
    for shards, load in enumerate(loads, 1):
        filled += load
        level = (amount + filled) // shards
        if shards == len(loads) or level <= loads[shards]:
            return level
    return 0


def schedule(runs: Iterable[tuple[int, int]], shards: int) -> Iterator[list[int]]:
    """For runs (size, groups) by falling size: how many of its groups each shard takes.

    The same as one ``heapreplace`` for each group. In a long run, all steps that end below a level
    which the run surely reaches are made at once; the heap takes the others.
    """
    heap = [(0, shard) for shard in range(shards)]
    for size, groups in runs:
        taken = [0] * shards
        if size == 0:
            taken[heap[0][1]] = groups
            groups = 0
        elif groups > 4 * shards:
            level = _level(sorted(load for load, _ in heap), (groups - shards) * size)
            for at, (load, shard) in enumerate(heap):
                taken[shard] = max(0, -((load - level) // size))
                heap[at] = (load + taken[shard] * size, shard)
            heapq.heapify(heap)
            groups -= sum(taken)
        for _ in range(groups):
            load, shard = heap[0]
            taken[shard] += 1
            heapq.heapreplace(heap, (load + size, shard))
        yield taken


def _shares(spark, runs: list[tuple[int, int]], shards: int) -> DataFrame:
    """(bytes, upto): after which rank among the groups of this size each shard's share ends."""
    ends = []
    for taken in schedule(runs, shards):
        total = 0
        ends.append([total := total + n for n in taken])
    table = pa.table(
        {
            "bytes": pa.array([size for size, _ in runs], pa.int64()),
            "upto": pa.array(ends, pa.list_(pa.int64())),
        }
    )
    return spark.createDataFrame(table)


def shard_groups(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (group: text or null, size: long, not negative, ...) with ``shard`` added.

    ``rows`` is read twice and should be stored. Groups of one size are ranked by their names. Sizes
    that many groups share, and groups of many rows, are joined apart.
    """
    spark = rows.sparkSession
    keyed = rows.withColumn("_key", F.coalesce("group", F.lit("")))
    groups, _ = store(
        keyed.groupBy("_key").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("_rows")),
        "shard-groups",
    )
    found = groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("groups")).toArrow()
    runs = sorted(
        zip(*(found.column(x).to_pylist() for x in ("bytes", "groups")), strict=True), reverse=True
    )
    if not runs:
        return rows.withColumn("shard", F.lit(None).cast("int"))
    shares = _shares(spark, runs, shards)
    ranked = number_within(
        groups, "bytes", ["_key"], "_rank", buckets_for(sum(n for _, n in runs))
    )
    if len(runs) * 8 * (shards + 1) <= BROADCAST_BYTES:
        placed = ranked.join(F.broadcast(shares), "bytes")
    else:
        common = groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("groups"))
        hot = hot_keys(common, ["bytes"], "groups", ROWS_PER_SLICE)
        placed = join_unique(ranked, shares, "bytes", hot)
    shard = F.size(F.filter("upto", lambda end: end <= F.col("_rank")))
    own, _ = store(placed.select("_key", shard.alias("shard")), "shard-of-group")
    return join_unique(
        keyed, own, "_key", hot_keys(groups, ["_key"], "_rows", ROWS_PER_SLICE)
    ).drop("_key")


def shard_documents(
    docs: DataFrame,
    shards: int = 16,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot); ``slot`` runs from 0 inside a shard.

    Size is the text's UTF-8 bytes plus 1. A null text has no bytes, crc32 0, and all null texts
    are one group, apart from the empty text's. Equal ids with equal texts get slots in any
    order. An empty table gives no rows; other columns are ignored.
    """
    text = F.col(text_column)
    rows, _ = store(
        docs.select(
            F.col(id_column).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
            utf8_crc32(text).alias("text_crc32"),
            F.md5(text.cast("binary")).alias("group"),
        ),
        "shard-rows",
    )
    sharded, _ = store(shard_groups(rows, shards), "sharded")
    numbered = number_within(
        sharded, "shard", ["doc_id", "text_crc32", "size"], "slot", buckets_for(sharded.count())
    )
    return numbered.select("doc_id", "size", "text_crc32", "shard", "slot")
