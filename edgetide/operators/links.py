"""Counted edges, and their layout for repeated joins with a rank table."""

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgetide.operators.keys import Keys, shortest_keys
from edgetide.operators.skew import ROWS_PER_SLICE, find_hot, hot_keys
from edgetide.operators.stats import CountedEdges, Edges, store_counted, with_copies
from edgetide.storage import drop_scratch, store

# Bounds on the distinct edges per partition; in between, the session's setting decides. Each round costs
# a block for every pair of partitions, so beyond some partitions the lower bound is a higher one.
FEW_ROWS = 50_000
FEW_PARTITIONS = 24
USUAL_ROWS = 300_000
MANY_ROWS = 20_000_000
# With fewer links of a target in a partition, combining them there takes more than it saves.
FEW_TOGETHER = 2
# From the second round on only links whose source is a target too carry anything; where they are at most
# this part of all, they are kept apart.
LATER_PART = 0.5


@contextmanager
def fixed_layout(spark: SparkSession, partitions: int) -> Iterator[None]:
    """Plans run inside shuffle into ``partitions`` and are not changed while they run.

    The rounds rely on the edges' partitioning: a rank table that is coalesced, or whose
    partitioning is hidden behind an adaptive plan, would have to be shuffled again. The
    settings are the session's while this lasts; jobs at the same time need their own sessions.
    """
    ours = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "false",
        # a saved layout is read by its buckets even where a plan alone would not need them
        "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in ours}
    for name, value in ours.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@dataclass(frozen=True)
class Links:
    """A graph laid out for the rounds.

    ``edges``   distinct edges (src*, dst*, weight) of all sources but hot ones, hash-partitioned and
                sorted by src* and cached; ``weight`` is the edge's part of its source's rank.
    ``spread``  the same of hot sources, partitioned by both ends and cached, or None.
    ``sources`` one row per source (src*, out_degree, fanout), of a large graph a stored table.
    ``nodes``   all node ids and whether links lead there (nodeId, target), a stored table.
    ``keys``    what src* and dst* are: short keys in place of ids.
    ``hot``     the sources in ``spread`` (src*, fanout), or None.
    ``tables``  names under which this session knows a saved layout's files.
    ``combine`` whether a round's sums are combined before its shuffle.
    ``later``   the rows of ``edges`` whose source is a target too, cached, or None where they are most.
    ``later_partitions`` in how many partitions these lie.
    """

    edges: DataFrame
    spread: DataFrame | None
    sources: DataFrame
    nodes: DataFrame
    keys: Keys
    hot: DataFrame | None
    partitions: int
    scratch: tuple[str, ...]
    tables: tuple[str, ...] = ()
    combine: bool = True
    later: DataFrame | None = None
    later_partitions: int = 0

    def after_first_round(self) -> "Links":
        """The same for ranks that only targets have, as they all do once a round is done."""
        if self.later is None:
            return self
        return replace(self, edges=self.later, partitions=self.later_partitions)

    @property
    def src(self) -> list[str]:
        return self.keys.names("src")

    def sizes(self) -> DataFrame:
        """One row: total_edges (with copies), total_nodes, source_nodes; tables only."""
        edges = self.sources.select(
            F.col("out_degree").alias("total_edges"),
            F.lit(0).cast("bigint").alias("total_nodes"),
            F.lit(1).cast("bigint").alias("source_nodes"),
        )
        none = F.lit(0).cast("bigint")
        ids = self.nodes.select(
            none.alias("total_edges"),
            F.lit(1).cast("bigint").alias("total_nodes"),
            none.alias("source_nodes"),
        )
        total = edges.unionByName(ids)
        return total.agg(
            *(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in total.columns)
        )

    def forget(self) -> None:
        """Drop the cached edges once the rounds are done; the tables stay."""
        for cached in (self.edges, self.spread, self.later):
            if cached is not None:
                cached.unpersist()

    def release(self) -> None:
        """Drop the cached edges and the stored tables; a saved layout's files stay."""
        spark = self.edges.sparkSession
        self.forget()
        for path in self.scratch:
            drop_scratch(spark, path)
        for name in self.tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def partitions_for(spark: SparkSession, rows: int) -> int:
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(min(FEW_PARTITIONS, -(-rows // FEW_ROWS)), -(-rows // USUAL_ROWS))
    return max(1, min(usual, wanted), -(-rows // MANY_ROWS))


def prepare_links(edges: Edges, rows_per_slice: int | None = None) -> Links:
    """Count, weigh and place the edges once, so that no round moves them again.

    ``edges`` is read once; edges that are not counted yet are counted and stored first, and nodes
    are stored too: a lost cache block is rebuilt from there and not from the input. The links are
    then shuffled once, by source. A source with
    more than ``rows_per_slice`` distinct links (by default an average partition's load, and
    at least ``ROWS_PER_SLICE``) is hot: its links are spread over all partitions and meet its rank
    by a broadcast of at most ``MAX_HOT`` rows.
    """
    spark = edges.sparkSession
    scratch = []
    if not isinstance(edges, CountedEdges):
        edges, edges_path = store_counted(edges)
        scratch.append(edges_path)
    ids, ids_path = store(_nodes(edges), "nodes")
    scratch.append(ids_path)
    keys = shortest_keys(ids)
    src, dst = keys.names("src"), keys.names("dst")
    # distinct by id, and no two ids share a key: nothing to combine
    counted = with_copies(edges).select(
        *keys.of("src", "src"), *keys.of("dst", "dst"), "copies"
    )
    sources = counted.groupBy(*src).agg(
        F.sum("copies").alias("out_degree"), F.count(F.lit(1)).alias("fanout")
    )
    links = counted.count()
    partitions = partitions_for(spark, links)
    threshold = rows_per_slice or max(ROWS_PER_SLICE, links // partitions)
    hot = None
    if links > threshold:
        sources, sources_path = store(sources, "sources")
        scratch.append(sources_path)
        hot = hot_keys(sources, src, "fanout", threshold)
    degrees = sources.select(*src, "out_degree")
    weight = (F.col("copies") / F.col("out_degree")).alias("weight")
    usual, spread = counted, None
    if hot is not None:
        keys_of_hot = F.broadcast(hot.select(*src))
        few = F.broadcast(degrees.join(keys_of_hot, src, "left_semi"))
        spread = (
            counted.join(few, src)
            .select(*src, *dst, weight)
            .repartition(partitions, *src, *dst)
            .persist()
        )
        usual = counted.join(keys_of_hot, src, "left_anti")
    with fixed_layout(spark, partitions):
        placed = (
            usual.repartition(partitions, *src)
            .join(degrees, src)
            .select(*src, *dst, weight)
            .sortWithinPartitions(*src)
            .persist()
        )
    targets = ids.where("target").count()
    later, later_partitions = None, 0
    if links > threshold:
        later, later_partitions = later_edges(placed, sources, ids, keys, partitions)
    return Links(
        placed, spread, sources, ids, keys, hot, partitions, tuple(scratch),
        combine=_combines(counted, dst, links, targets, partitions, threshold),
        later=later, later_partitions=later_partitions,
    )


def _nodes(edges: CountedEdges) -> DataFrame:
    """Every id seen at either end, once, and whether it is a target: (nodeId, target)."""

    def end(node: str, target: bool):
        return F.struct(F.col(node).alias("nodeId"), F.lit(target).alias("target"))

    ends = edges.rows.select(F.inline(F.array(end("src", False), end("dst", True))))
    return ends.groupBy("nodeId").agg(F.max("target").alias("target"))


def later_edges(
    placed: DataFrame, sources: DataFrame, nodes: DataFrame, keys: Keys, partitions: int
) -> tuple[DataFrame | None, int]:
    """The placed edges whose source is a target, cached, and in how many partitions; None where they are most.

    They lie in no more partitions than they and the nodes are worth: a round among few links would
    otherwise cost what its partitions do.
    """
    src = keys.names("src")
    # not known of nodes kept before this was: they count as targets
    targets = nodes.where("target is not false").select(*keys.of("nodeId", "src"))
    live = sources.join(targets, src, "left_semi").select(*src, "fanout")
    few, all_links = (table.agg(F.sum("fanout")).first()[0] or 0 for table in (live, sources))
    if few > LATER_PART * all_links:
        return None, 0
    spark = placed.sparkSession
    own = min(partitions, partitions_for(spark, max(few, nodes.count())))
    with fixed_layout(spark, partitions):
        rows = placed.join(live.select(*src), src, "left_semi")
        if own < partitions:
            rows = rows.repartition(own, *src)
        return rows.sortWithinPartitions(*src).persist(), own


def _combines(
    counted: DataFrame, dst: list[str], links: int, targets: int, partitions: int, threshold: int
) -> bool:
    """Whether sums should be combined before the shuffle.

    They always are in a small graph and where a target is hot, as its contributions would all go
    to one task.
    """
    if links <= threshold or links >= FEW_TOGETHER * targets * partitions:
        return True
    return find_hot(counted.select(*dst), dst, "fanin", threshold) is not None
