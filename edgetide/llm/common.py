"""Small helpers that several operators share."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edgetide.storage import store

# What separates words, and what a word is.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

ROWS_PER_BUCKET = 4096
# What a task hands to Python at once; a batch is held several times on its way.
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside hand rows to Python in batches of about ``BATCH_BYTES``.

    By default a batch holds up to 64 MB, of which a task and its worker keep several copies outside
    the heap. The setting is the session's while this lasts.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def scan(values: Column, zero: Column, join) -> Column:
    """For each element, ``join`` over all elements before it, from ``zero``.

    Two levels of runs of about the root of the length, so that long arrays stay cheap.
    """

    def over(values: Column, run: Column) -> Column:
        def upto(of: Column, start: Column, length: Column, first: Column) -> Column:
            return F.aggregate(F.slice(of, start, length), first, join)

        def heads(totals: Column) -> Column:
            return F.transform(totals, lambda _, j: upto(totals, F.lit(1), j, zero))

        last = F.floor((F.size(values) - 1) / run).cast("int")
        totals = F.transform(
            F.sequence(F.lit(0), last), lambda j: upto(values, j * run + 1, run, zero)
        )
        return bind(
            bind(totals, heads),
            lambda heads: F.transform(
                values,
                lambda _, i: bind(
                    F.floor(i / run).cast("int"),
                    lambda j: upto(values, j * run + 1, i - j * run, F.get(heads, j)),
                ),
            ),
        )

    def start(values: Column) -> Column:
        run = F.ceil(F.sqrt(F.size(values))).cast("int")
        found = bind(run, lambda run: over(values, run))
        return F.when(F.size(values) == 0, F.slice(values, 1, 0)).otherwise(found)

    return bind(values, start)


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def utf8_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; that of no bytes, 0, for null."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def id_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(utf8_crc32(doc_id.cast("string")), F.lit(folds))


def buckets_for(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(1, -(-rows // rows_per_bucket))


def number_within(
    rows: DataFrame, group: str, order: list[str], name: str, buckets: int
) -> DataFrame:
    """Add ``name``: 0, 1, ... without gaps inside each ``group``.

    Rows are dealt into ``buckets`` by the hash of ``order``; a window numbers a bucket's few
    rows and the counts of the buckets before it are added. No task sees a whole group.
    ``rows`` is read twice and should be stored.
    """
    bucketed = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy("_group").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        bucketed.groupBy(F.col(group).alias("_group"), F.col("_bucket").alias("_at"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "_group", "_at", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
        )
    )
    inside = Window.partitionBy(group, "_bucket").orderBy(*order)
    numbered = bucketed.withColumn("_place", F.row_number().over(inside) - 1)
    meet = numbered[group].eqNullSafe(starts["_group"]) & (numbered["_bucket"] == starts["_at"])
    return (
        numbered.join(starts, meet)
        .withColumn(name, (F.col("_before") + F.col("_place")).cast("bigint"))
        .drop("_bucket", "_group", "_at", "_before", "_place")
    )


def number_in_order(table: DataFrame, order: Column, label: str) -> DataFrame:
    """Add ``position`` 0, 1, ... over the whole table in ``order``.

    The table is range-partitioned and stored; what is summed in one task is a count for each
    partition.
    """
    ranged, _ = store(
        table.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), label
    )
    parts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    place = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return (
        ranged.withColumn("_place", place)
        .join(starts, "_part")
        .withColumn("position", F.col("_before") + F.col("_place"))
        .drop("_part", "_before", "_place")
    )
