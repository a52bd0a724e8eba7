"""Connected components by alternating large and small stars, a stored table for each."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgetide.storage import drop_scratch, store

ROWS_PER_TASK = 50_000


def in_few_tasks(table: DataFrame, rows: int) -> DataFrame:
    """A stored table of ``rows`` rows, read by no more tasks than these are worth."""
    return table.coalesce(max(1, -(-rows // ROWS_PER_TASK)))


def _least(edges: DataFrame) -> DataFrame:
    """(u, least): the smallest of each node's neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: bigint); the root is the smallest reachable.

    A round hangs every node's larger neighbours on its smallest neighbour, then the smaller ones;
    neighbours are only ever reduced by a combined minimum and joined, never gathered. It ends
    when a round leaves the edges as they were. Repeated edges and loops do no harm; an empty
    table gives no rows.
    """
    spark = edges.sparkSession

    def kept(table: DataFrame, old: str | None = None) -> tuple[DataFrame, str, tuple]:
        """The table stored, its path, and a mark of what it holds; ``old`` is not needed then."""
        stored, path = store(table.distinct(), "edges")
        if old:
            drop_scratch(spark, old)
        total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        mark = tuple(stored.agg(F.count(F.lit(1)), total).first())
        return in_few_tasks(stored, mark[0]), path, mark

    current, path, before = kept(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    )
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large, path, _ = kept(
            both.join(_least(both), "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "least").alias("v")),
            path,
        )
        on_least = F.array(
            F.struct(F.col("u"), F.col("least").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("least").alias("v")),
        )
        joined = large.join(_least(large), "u").select(F.inline(on_least))
        current, path, after = kept(joined.where("u != v"), path)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
