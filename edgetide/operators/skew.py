"""Joins and groupings that hold when one key owns a large share of the rows.

Hot keys are the ``MAX_HOT`` heaviest ones above a row threshold. Every key left out owns
at most 1/MAX_HOT of all rows, which a plain shuffle handles; the hot ones are few enough to
broadcast. Nothing is dropped on either side.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgetide.storage import checkpoint

ROWS_PER_SLICE = 1_000_000
MAX_HOT = 20_000
BROADCAST_ROWS = 500_000
# Keys are first counted by so many hash buckets, which tasks combine to a small table.
BUCKETS = 16_384
BROADCAST_BYTES = 64 << 20


def hot_keys(
    sizes: DataFrame, key: list[str], size: str, threshold: int
) -> DataFrame | None:
    """The heaviest keys of ``sizes`` (one row per key) with more than ``threshold`` rows.

    Columns: the key and its size. None when no key is that heavy.
    """
    heaviest = (
        sizes.where(F.col(size) > threshold)
        .select(*key, size)
        .orderBy(F.desc(size), *key)
        .limit(MAX_HOT)
    )
    hot = checkpoint(heaviest)
    return None if hot.isEmpty() else hot


def in_heavy_buckets(
    rows: DataFrame, key: list[str], size: Column, threshold: int
) -> DataFrame | None:
    """The rows of every key whose ``size`` may exceed ``threshold``, and of few others; None if there are none.

    A key cannot be larger than its hash bucket, so nothing is missed; without a heavy bucket no rows
    are shuffled.
    """
    bucket = F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).alias("_bucket")
    counts = rows.groupBy(bucket).agg(size.alias("_size"))
    heavy = checkpoint(counts.where(F.col("_size") > threshold).select("_bucket"))
    if heavy.isEmpty():
        return None
    found = rows.select("*", bucket).join(F.broadcast(heavy), "_bucket", "left_semi")
    return found.drop("_bucket")


def find_hot(
    rows: DataFrame, key: list[str], size: str, threshold: int
) -> DataFrame | None:
    """``hot_keys`` of plain rows, which are counted by key only where a bucket of keys is that heavy."""
    count = F.count(F.lit(1))
    few = in_heavy_buckets(rows.select(*key), key, count, threshold)
    if few is None:
        return None
    return hot_keys(few.groupBy(*key).agg(count.alias(size)), key, size, threshold)


def fits_broadcast(table: DataFrame, key: str) -> bool:
    """Whether a materialised table is small enough to broadcast, by rows and key bytes."""
    size = (
        table.select(F.octet_length(key).alias("bytes"))
        .agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
        .first()
    )
    return size["rows"] <= BROADCAST_ROWS and size["bytes"] <= BROADCAST_BYTES


def join_unique(
    rows: DataFrame, table: DataFrame, key: str, hot: DataFrame | None, how: str = "inner"
) -> DataFrame:
    """Join ``rows`` with a ``table`` that is unique on ``key``, hot keys apart.

    The table holds at most one row per hot key, so that part is broadcast; the remaining
    rows go through an ordinary shuffle join.
    """
    if hot is None:
        return rows.join(table, key, how)
    hot = F.broadcast(hot.select(key))
    few = F.broadcast(table.join(hot, key, "left_semi"))
    heavy = rows.join(hot, key, "left_semi").join(few, key, how)
    return heavy.unionByName(rows.join(hot, key, "left_anti").join(table, key, how))


def rows_matching(rows: DataFrame, ids: DataFrame, key: str, threshold: int) -> DataFrame:
    """Rows whose key is among the materialised, distinct ``ids``."""
    if fits_broadcast(ids, key):
        return rows.join(F.broadcast(ids), key, "left_semi")
    return join_unique(rows, ids, key, find_hot(rows, [key], "size", threshold), "left_semi")
