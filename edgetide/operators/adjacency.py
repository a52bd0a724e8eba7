"""Neighbour lists, duplicates kept.

A list is one row as long as it has at most ``ENTRIES_PER_LIST`` entries. A longer one is cut into
contiguous ranges of that many entries, one row each (``part`` 0, 1, ...); the parts in order are
the sorted list, so that no task and no row ever carries a hub whole.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgetide.operators.skew import fits_broadcast, hot_keys, in_heavy_buckets, join_unique
from edgetide.operators.stats import CountedEdges, Edges, store_counted
from edgetide.storage import checkpoint

ENTRIES_PER_LIST = 100_000


def _cut(rows: DataFrame, key: str, other: str, limit: int) -> DataFrame:
    """The part of each entry of long lists, and how many of its copies lie in it.

    Rows are sorted by ranges, which cut a hub over many partitions; an entry's place is the sum
    before it in its range plus the sums of the key's earlier ranges.
    """
    ranged = checkpoint(
        rows.repartitionByRange(key, other).withColumn("chunk", F.spark_partition_id())
    )
    inside = Window.partitionBy(key, "chunk").orderBy(other)
    of_key = Window.partitionBy(key)
    earlier = of_key.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = ranged.groupBy(key, "chunk").agg(F.sum("copies").alias("held"))
    chunks = chunks.select(
        key,
        "chunk",
        F.sum("held").over(of_key).alias("size"),
        F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"),
    )
    end = F.col("before") + F.sum("copies").over(inside)
    placed = ranged.join(chunks, [key, "chunk"]).select(
        key, other, "size", end.alias("end"), (end - F.col("copies")).alias("start")
    )
    cut = int(limit)
    parts = F.explode(F.expr(f"sequence(start div {cut}, (end - 1) div {cut})"))
    return placed.withColumn("part", parts).select(
        key,
        other,
        "size",
        "part",
        (
            F.least(F.col("end"), (F.col("part") + 1) * cut)
            - F.greatest(F.col("start"), F.col("part") * cut)
        )
        .cast("int")
        .alias("copies"),
    )


def neighbor_lists(
    edges: Edges, key: str, other: str, limit: int = ENTRIES_PER_LIST, stored: bool = False
) -> DataFrame:
    """(key, part, count, entries): sorted neighbours per key; ``count`` covers all parts.

    ``edges`` is read once; sizes and lists come from its stored, counted rows. Counted edges that
    are ``stored`` already are read where they are.
    """
    known = stored and isinstance(edges, CountedEdges)
    counted = edges.rows if known else store_counted(edges)[0].rows
    sizes = in_heavy_buckets(counted, [key], F.sum("copies"), limit)
    if sizes is not None:
        sizes = sizes.groupBy(key).agg(F.sum("copies").alias("size"))
        long = checkpoint(sizes.where(F.col("size") > limit))
    none = F.lit(None).cast("bigint").alias("size")
    first = F.lit(0).cast("bigint").alias("part")
    columns = [key, other, none, first, F.col("copies").cast("int").alias("copies")]
    if sizes is None or long.isEmpty():
        entries = counted.select(*columns)
    else:
        if fits_broadcast(long, key):
            found = F.broadcast(long.select(key))
            rows = counted.join(found, key, "left_semi")
        else:
            hot = hot_keys(long, [key], "size", limit)
            rows = join_unique(counted, long.select(key), key, hot, "left_semi")
            found = long.select(key)
        short = counted.join(found, key, "left_anti").select(*columns)
        entries = short.unionByName(_cut(rows, key, other, limit))
    runs = F.sort_array(F.collect_list(F.struct(other, "copies")))
    return (
        entries.groupBy(key, "part")
        .agg(F.coalesce(F.max("size"), F.sum("copies")).alias("count"), runs.alias("runs"))
        .select(
            key,
            "part",
            "count",
            F.flatten(
                F.transform("runs", lambda run: F.array_repeat(run[other], run["copies"]))
            ).alias("entries"),
        )
    )


def adjacency(
    edges: Edges, limit: int = ENTRIES_PER_LIST, stored: bool = False
) -> DataFrame:
    """(nodeId, part, neighbors) for every source."""
    return neighbor_lists(edges, "src", "dst", limit, stored).select(
        F.col("src").alias("nodeId"), "part", F.col("entries").alias("neighbors")
    )


def reverse_adjacency(edges: Edges, limit: int = ENTRIES_PER_LIST) -> DataFrame:
    """(nodeId, part, sources) for every target."""
    return neighbor_lists(edges, "dst", "src", limit).select(
        F.col("dst").alias("nodeId"), "part", F.col("entries").alias("sources")
    )
