"""Edges kept for many look-ups, sorted by either end.

A look-up then reads the few files and row groups whose value range covers the id. Ranges are
cut over (end, other end), so a hub's edges lie in as many files as they need.

An index for look-ups of many ids is also partitioned by a hash of the end: ids lead to their
folders, and Spark prunes the others at run time by the ids' own buckets.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgetide.operators.stats import CountedEdges, Edges, store_counted
from edgetide.storage import drop_scratch

_ENDS = {"outgoing": ("src", "dst"), "incoming": ("dst", "src")}
_SCHEMA = "src string, dst string, copies bigint"
INDEX_BUCKETS = 64


def bucket_of(node: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class BucketedEdges(CountedEdges):
    """Counted edges on files partitioned by ``bucket``, a hash of ``key``.

    ``located`` has that column beside those of ``rows``.
    """

    located: DataFrame
    key: str
    buckets: int

    def at(self, key: str, node_id: str) -> CountedEdges:
        """The edges with ``node_id`` at ``key``; from one bucket where the index is by that end."""
        found = self.located.where(F.col(key) == F.lit(node_id))
        if key == self.key:
            found = found.where(F.col("bucket") == bucket_of(F.lit(node_id), self.buckets))
        return CountedEdges(found.drop("bucket"))

    def at_all(self, ids: DataFrame) -> CountedEdges:
        """The edges whose key is among ``ids`` (a small, stored table): their buckets only are read."""
        bucket = bucket_of(F.col(self.key), self.buckets).alias("bucket")
        # the comparison holds for every bucket and lets Spark prune by the ids
        wanted = ids.select(self.key, bucket).where("bucket >= 0")
        found = self.located.join(F.broadcast(wanted), ["bucket", self.key], "left_semi")
        return CountedEdges(found.select("src", "dst", "copies"))


def write_index(edges: Edges, folder: str, buckets: int | None = None) -> None:
    """Write the counted edges twice, ``outgoing`` by source and ``incoming`` by target.

    Edges that are not counted yet are counted once, for both. With ``buckets`` each copy is also
    partitioned by a hash of its end.
    """
    counted, path = (edges, None) if isinstance(edges, CountedEdges) else store_counted(edges)
    for direction, ends in _ENDS.items():
        rows, order = counted.rows, list(ends)
        if buckets:
            rows = rows.withColumn("bucket", bucket_of(F.col(ends[0]), buckets))
            order = ["bucket", *ends]
        ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        target = f"{folder}/{direction}"
        if buckets:
            ranged.write.partitionBy("bucket").parquet(f"{target}/buckets={buckets}")
        else:
            ranged.write.parquet(target)
    if path:
        drop_scratch(edges.sparkSession, path)


def read_index(
    spark: SparkSession, folder: str, direction: str, buckets: int | None = None
) -> CountedEdges:
    """Counted edges for ``neighbors`` (outgoing) or ``influenced_by`` (incoming).

    ``buckets`` is what the index was written with.
    """
    path = f"{folder}/{direction}"
    if not buckets:
        return CountedEdges(spark.read.schema(_SCHEMA).parquet(path))
    located = spark.read.schema(f"{_SCHEMA}, bucket int").parquet(f"{path}/buckets={buckets}")
    rows = located.select("src", "dst", "copies")
    return BucketedEdges(rows, located, _ENDS[direction][0], buckets)
