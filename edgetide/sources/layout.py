"""A graph's layout kept between jobs: bucketed tables that later rounds join without a shuffle.

    <folder>/nodes         all ids, and whether links lead there
    <folder>/sources       out-degrees
    <folder>/links         weighted links, bucketed and sorted by source
    <folder>/spread        the same of hot sources, bucketed by both ends, if there are any
    <folder>/hot           hot sources, if there are any
    <folder>/description   one JSON line, written last
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgetide.operators.keys import Keys
from edgetide.operators.links import Links, fixed_layout, later_edges
from edgetide.operators.stats import CountedEdges
from edgetide.storage import delete, finished

_DESCRIPTION = "hashes int, partitions int, hot boolean, combine boolean"


def fingerprint(edges: CountedEdges) -> str:
    """A name for the edges with their copies, whatever their order and files.

    Counts and two sums of hashes; graphs that differ share it at about 1 in 10^38.
    """
    row = ["src", "dst", F.col("copies").cast("bigint")]
    found = edges.rows.agg(
        F.count(F.lit(1)).alias("edges"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("links"),
        *(
            F.coalesce(F.sum(F.xxhash64(F.lit(i), *row).cast("decimal(38,0)")), F.lit(0)).alias(f"h{i}")
            for i in (0, 1)
        ),
    )
    return found.select(F.md5(F.concat_ws(" ", *found.columns))).first()[0]


def _bucketed(rows: DataFrame, by: list[str], buckets: int, path: str) -> None:
    """Write ``rows``, which lie partitioned by ``by`` already: a file for each bucket."""
    spark, name = rows.sparkSession, f"edgetide_{uuid.uuid4().hex}"
    delete(spark, path)  # what an unfinished attempt left
    writer = rows.write.bucketBy(buckets, *by).sortBy(*by).option("path", path)
    writer.format("parquet").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay


def _opened(
    spark: SparkSession, path: str, schema: str, by: list[str], buckets: int
) -> tuple[DataFrame, str]:
    """The bucketed files as a table of this session, and the table's name."""
    name = f"edgetide_{uuid.uuid4().hex}"
    keys = ", ".join(by)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({keys}) "
        f"SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    return spark.table(name), name


def save_links(links: Links, folder: str) -> None:
    """Write a prepared graph; it can be opened once the description is there."""
    spark, src, dst = links.edges.sparkSession, links.src, links.keys.names("dst")
    links.nodes.write.mode("overwrite").parquet(f"{folder}/nodes")
    links.sources.write.mode("overwrite").parquet(f"{folder}/sources")
    with fixed_layout(spark, links.partitions):
        _bucketed(links.edges, src, links.partitions, f"{folder}/links")
        if links.hot is not None:
            _bucketed(links.spread, [*src, *dst], links.partitions, f"{folder}/spread")
            links.hot.write.mode("overwrite").parquet(f"{folder}/hot")
    described = spark.range(1).select(
        F.lit(links.keys.hashes).alias("hashes"),
        F.lit(links.partitions).alias("partitions"),
        F.lit(links.hot is not None).alias("hot"),
        F.lit(links.combine).alias("combine"),
    )
    described.write.mode("overwrite").json(f"{folder}/description")


def open_links(spark: SparkSession, folder: str) -> Links | None:
    """The saved layout, its links cached where they lie; None if none is finished."""
    if not finished(spark, f"{folder}/description"):
        return None
    known = spark.read.schema(_DESCRIPTION).json(f"{folder}/description").first()
    keys, partitions = Keys(known["hashes"]), known["partitions"]
    src, dst = keys.names("src"), keys.names("dst")
    kind = "bigint" if keys.hashes else "string"
    schema = ", ".join([*(f"{name} {kind}" for name in (*src, *dst)), "weight double"])
    names, spread, hot = [], None, None
    sources = spark.read.parquet(f"{folder}/sources")
    nodes = spark.read.schema("nodeId string, target boolean").parquet(f"{folder}/nodes")
    with fixed_layout(spark, partitions):
        edges, name = _opened(spark, f"{folder}/links", schema, src, partitions)
        names.append(name)
        edges = edges.sortWithinPartitions(*src).persist()
        if known["hot"]:
            by = [*src, *dst]
            spread, name = _opened(spark, f"{folder}/spread", schema, by, partitions)
            names.append(name)
            spread, hot = spread.persist(), spark.read.parquet(f"{folder}/hot")
    later, later_partitions = later_edges(edges, sources, nodes, keys, partitions)
    return Links(
        edges,
        spread,
        sources,
        nodes,
        keys,
        hot,
        partitions,
        (),
        tuple(names),
        # a layout described before this was known: combining is always right
        known["combine"] is not False,
        later,
        later_partitions,
    )
