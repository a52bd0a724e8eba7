"""Saved results: one folder per finished job, metadata written last.

    <out>/version=<v>/top       best five with place, JSON lines
    <out>/version=<v>/stored    best thousand, JSON lines
    <out>/version=<v>/places    best thousand with their place, Parquet, for reading
    <out>/version=<v>/ranking   all nodes best first, text: node, tab, score
    <out>/version=<v>/scores    all nodes best first, Parquet with place and full score, for reading
    <out>/version=<v>/by_id     the same ordered by id, with Bloom filters, for look-ups by id
    <out>/version=<v>/graph     neighbour lists, JSON lines
    <out>/version=<v>/index     counted edges sorted by either end, Parquet, for look-ups
    <out>/version=<v>/edges     one JSON line: the version that holds graph and index, this one or an
                                earlier one of the same edges, and the most entries of a list's row
    <out>/version=<v>/metadata  one JSON line; a version without it does not exist for readers
"""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgetide.functions.text import rounded
from edgetide.operators.adjacency import ENTRIES_PER_LIST, adjacency
from edgetide.operators.stats import CountedEdges, Edges
from edgetide.operators.topk import in_ranges, lines, numbered, top_list
from edgetide.schema import ADJACENCY, METADATA, RANKS, STORED, TOP, TOP_LIST
from edgetide.sources.index import INDEX_BUCKETS, read_index, write_index
from edgetide.storage import delete, finished, named

_HOLDER = "version string, entries_per_list bigint"


class ResultsNotReady(Exception):
    """No finished version under the given folder."""


@dataclass(frozen=True)
class Results:
    version: str
    top: DataFrame
    stored: DataFrame
    ranking: DataFrame
    graph: DataFrame
    metadata: DataFrame
    outgoing: CountedEdges
    incoming: CountedEdges
    # (rank, nodeId, pagerank) of all nodes, ordered by place and by id
    places: DataFrame
    by_id: DataFrame

    @property
    def edges(self) -> CountedEdges:
        """The saved edges sorted by source, for ``neighbors``."""
        return self.outgoing


def job_metadata(
    sizes: DataFrame,
    ranks: DataFrame,
    dataset_name: str,
    iterations: int,
    damping: float,
    completed_at: str,
) -> DataFrame:
    """The one-row description of a job; ``top_node`` is null for an empty ranking.

    ``sizes`` is the row of ``graph_stats`` or of ``Links.sizes``.
    """
    known = sizes.select(
        "total_nodes", "total_edges", F.lit(None).cast("string").alias("top_node")
    )
    none = F.lit(None).cast("bigint")
    best = top_list(ranks, 1).select(
        none.alias("total_nodes"), none.alias("total_edges"), F.col("nodeId").alias("top_node")
    )
    return (
        known.unionByName(best)
        .agg(*(F.max(name).alias(name) for name in ("total_nodes", "total_edges", "top_node")))
        .select(
            F.lit(dataset_name).alias("dataset_name"),
            "total_nodes",
            "total_edges",
            F.lit(iterations).cast("bigint").alias("iterations"),
            F.lit(float(damping)).alias("damping_factor"),
            "top_node",
            F.lit(completed_at).alias("completed_at"),
        )
    )


def write_edges(edges: Edges, folder: str, limit: int = ENTRIES_PER_LIST) -> None:
    """Neighbour lists and index; ``limit`` is the most entries a neighbour list's row holds."""
    adjacency(edges, limit, stored=True).write.json(f"{folder}/graph")
    write_index(edges, f"{folder}/index", INDEX_BUCKETS)


def name_edges(spark: SparkSession, folder: str, holder: str, limit: int) -> None:
    """Note in a version's ``folder`` that graph and index lie with the version ``holder``."""
    row = spark.range(1).select(
        F.lit(holder).alias("version"), F.lit(limit).cast("bigint").alias("entries_per_list")
    )
    row.write.json(f"{folder}/edges")


def holder_of(spark: SparkSession, out_dir: str, version: str) -> tuple[str, int | None]:
    """The version that holds a version's graph and index, and the most entries of a list's row there.

    A version written before this was noted holds its own, with a limit that is not known.
    """
    path = f"{out_dir}/version={version}/edges"
    if not finished(spark, path):
        return version, None
    found = spark.read.schema(_HOLDER).json(path).first()
    return found["version"], found["entries_per_list"]


def write_rankings(ranks: DataFrame, folder: str) -> None:
    """All that depends on the ranks, which are ordered once: places, scores and text come from the same ranges."""
    spark = ranks.sparkSession
    ranged = in_ranges(ranks).persist()
    ranking = numbered(ranged)
    ranking.write.parquet(f"{folder}/scores")
    lines(ranking).write.text(f"{folder}/ranking")
    ranged.unpersist()
    scores = spark.read.schema(TOP_LIST).parquet(f"{folder}/scores")
    best = scores.where(F.col("rank") <= STORED).withColumn("pagerank", rounded(F.col("pagerank")))
    best.coalesce(1).sortWithinPartitions("rank").write.parquet(f"{folder}/places")
    places = spark.read.schema(TOP_LIST).parquet(f"{folder}/places")
    places.where(F.col("rank") <= TOP).orderBy("rank").write.json(f"{folder}/top")
    places.orderBy("rank").drop("rank").write.json(f"{folder}/stored")
    write_by_id(scores, f"{folder}/by_id")


def write_by_id(scores: DataFrame, path: str) -> None:
    """Scores in order of id: a look-up reads the row groups whose range and Bloom filter fit."""
    ranged = scores.repartitionByRange("nodeId").sortWithinPartitions("nodeId")
    ranged.write.option("parquet.bloom.filter.enabled#nodeId", "true").parquet(path)


def write_metadata(metadata: DataFrame, folder: str) -> None:
    metadata.coalesce(1).write.json(f"{folder}/metadata")


def _newest(spark: SparkSession, out_dir: str) -> str:
    schema = T.StructType([*METADATA.fields, T.StructField("version", T.StringType())])
    try:
        found = (
            spark.read.schema(schema)
            .option("basePath", out_dir)
            .json(f"{out_dir}/version=*/metadata")
            .agg(F.max("version").alias("version"))
            .first()["version"]
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = None
    if found is None:
        raise ResultsNotReady(f"no finished results under {out_dir}")
    return found


def drop_versions(spark: SparkSession, out_dir: str, keep: int) -> None:
    """Delete all but the newest ``keep`` finished versions and those that hold the edges of these.

    Unfinished ones are left alone.
    """
    if keep <= 0:
        return
    versions = named(spark, out_dir, "version", "metadata/_SUCCESS")
    held = {holder_of(spark, out_dir, version)[0] for version in versions[-keep:]}
    for version in versions[:-keep]:
        if version not in held:
            delete(spark, f"{out_dir}/version={version}")


def read_ranking(spark: SparkSession, path: str) -> DataFrame:
    """The exported text form, ten decimals; the node is all before the last tab."""
    line, score = F.col("value"), F.substring_index("value", "\t", -1)
    # spark.read.text also ends lines at a lone carriage return unless told otherwise
    return spark.read.option("lineSep", "\n").text(path).select(
        F.substr(line, F.lit(1), F.length(line) - F.length(score) - 1).alias(RANKS.fieldNames()[0]),
        score.cast("double").alias(RANKS.fieldNames()[1]),
    )


def read_results(spark: SparkSession, out_dir: str, version: str | None = None) -> Results:
    """The newest finished version, or the named one."""
    version = version or _newest(spark, out_dir)
    folder = f"{out_dir}/version={version}"
    held = f"{out_dir}/version={holder_of(spark, out_dir, version)[0]}"
    return Results(
        version,
        spark.read.schema(TOP_LIST).json(f"{folder}/top"),
        spark.read.schema(TOP_LIST).parquet(f"{folder}/places"),
        spark.read.schema(RANKS).parquet(f"{folder}/scores"),
        spark.read.schema(ADJACENCY).json(f"{held}/graph"),
        spark.read.schema(METADATA).json(f"{folder}/metadata"),
        read_index(spark, f"{held}/index", "outgoing", INDEX_BUCKETS),
        read_index(spark, f"{held}/index", "incoming", INDEX_BUCKETS),
        spark.read.schema(TOP_LIST).parquet(f"{folder}/scores"),
        spark.read.schema(TOP_LIST).parquet(f"{folder}/by_id"),
    )
