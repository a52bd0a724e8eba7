"""Edge files: tab-separated, blank-separated and comma-separated text, plain or gzipped."""

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from edgetide.functions.text import blank_fields, tab_fields
from edgetide.schema import EDGES


def _well_formed(ok: Column, shown: Column, on_malformed: str) -> Column:
    if on_malformed == "drop":
        return ok
    if on_malformed == "fail":
        message = F.concat(F.lit("edge line needs two fields: "), F.coalesce(shown, F.lit("")))
        return F.when(ok, True).otherwise(F.raise_error(message).cast("boolean"))
    raise ValueError("on_malformed must be 'fail' or 'drop'")


def parse_tab(lines: DataFrame, on_malformed: str = "fail") -> DataFrame:
    """Edges from the first two tab fields of each line.

    Lines without a tab and lines with ``#`` in the first column are no edges. A line that
    holds a tab but only one field once trimmed is malformed.
    """
    line = F.col("value")
    candidates = lines.where(~line.startswith("#") & line.contains("\t"))
    fields = candidates.select("value", tab_fields(line).alias("fields"))
    return fields.where(_well_formed(F.size("fields") >= 2, line, on_malformed)).select(
        F.col("fields")[0].alias("src"), F.col("fields")[1].alias("dst")
    )


def parse_blank(lines: DataFrame) -> DataFrame:
    """Edges from lines of exactly two tokens separated by any run of blanks."""
    line = F.col("value")
    fields = lines.where(~line.startswith("#")).select(blank_fields(line).alias("fields"))
    return fields.where(F.size("fields") == 2).select(
        F.col("fields")[0].alias("src"), F.col("fields")[1].alias("dst")
    )


def _edges(
    reader: DataFrameReader | DataStreamReader, path: str, fmt: str, on_malformed: str
) -> DataFrame:
    if fmt == "tab":
        return parse_tab(reader.text(path), on_malformed)
    if fmt == "blank":
        return parse_blank(reader.text(path))
    if fmt == "csv":
        rows = reader.csv(path, schema=EDGES, sep=",", comment="#")
        ok = F.col("src").isNotNull() & F.col("dst").isNotNull()
        return rows.where(_well_formed(ok, F.concat_ws(",", "src", "dst"), on_malformed))
    raise ValueError("fmt must be 'tab', 'blank' or 'csv'")


def read_edges(
    spark: SparkSession,
    path: str,
    fmt: str = "tab",
    on_malformed: str = "fail",
    partitions: int | None = None,
) -> DataFrame:
    """Edges of the files under ``path``, on any Hadoop file system, compressed or not.

    ``fmt`` is ``tab``, ``blank`` or ``csv``. A gzip file is read by one task; give
    ``partitions`` to spread its edges before further work.
    """
    edges = _edges(spark.read, path, fmt, on_malformed)
    return edges.repartition(partitions) if partitions else edges


def stream_edges(
    spark: SparkSession,
    path: str,
    fmt: str = "tab",
    on_malformed: str = "fail",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """The same reader over a folder that receives new files."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _edges(reader, path, fmt, on_malformed)
