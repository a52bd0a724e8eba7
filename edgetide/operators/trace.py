"""Which nodes lie within a few hops of a start, by which way, and how far two nodes are apart."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgetide.operators.links import fixed_layout, partitions_for
from edgetide.operators.skew import BROADCAST_BYTES, BROADCAST_ROWS, ROWS_PER_SLICE, hot_keys
from edgetide.operators.stats import CountedEdges, Edges, store_counted
from edgetide.storage import checkpoint, drop_scratch, store

# Starts kept apart by one bitmap.
STARTS_PER_WORD = 64


@dataclass
class _Frontier:
    """Nodes met first at one hop (nodeId; via), checkpointed and partitioned by node.

    ``via`` is the least node of the hop before that links there; a start has none.
    """

    nodes: DataFrame
    size: int
    small: bool

    @classmethod
    def of(cls, nodes: DataFrame) -> "_Frontier":
        nodes = checkpoint(nodes)
        found = nodes.agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(F.octet_length("nodeId")), F.lit(0)).alias("bytes"),
        ).first()
        few = found["rows"] <= BROADCAST_ROWS and found["bytes"] <= BROADCAST_BYTES
        return cls(nodes, found["rows"], few)


class _Walk:
    """A walk hop by hop in one direction.

    Distinct edges are placed once, by the end they are left from, and cached; the edges of hubs are
    spread over all partitions. A hop keeps the edges that leave the frontier, which is broadcast if
    small and otherwise joined in place (hubs in it are broadcast: few), and reduces them to distinct
    targets by a shuffle. The frontiers together are the visited nodes; one join takes these away,
    however many hops there were. Links never move; ids of visited nodes do, at most once in a hop.
    """

    def __init__(
        self,
        counted: CountedEdges,
        starts: DataFrame,
        back: bool,
        rows_per_slice: int,
        ways: bool = True,
    ) -> None:
        self.ways = ways
        self.here, self.there = ("dst", "src") if back else ("src", "dst")
        self.spark = counted.sparkSession
        links = counted.rows.select(self.here, self.there)
        count = links.count()
        self.partitions = partitions_for(self.spark, count)
        hot = None
        if count > rows_per_slice:
            sizes = links.groupBy(self.here).agg(F.count(F.lit(1)).alias("size"))
            hot = hot_keys(sizes, [self.here], "size", rows_per_slice)
        with fixed_layout(self.spark, self.partitions):
            usual, self.spread = links, None
            if hot is not None:
                self.hubs = F.broadcast(hot.select(self.here))
                usual = links.join(self.hubs, self.here, "left_anti")
                of_hubs = links.join(self.hubs, self.here, "left_semi")
                self.spread = of_hubs.repartition(self.partitions, self.here, self.there).persist()
            self.usual = usual.repartition(self.partitions, self.here).persist()
            first = starts.select(F.col("nodeId").cast("string")).distinct()
            first = first.repartition(self.partitions, "nodeId")
            self.frontiers = [_Frontier.of(first)]

    @property
    def visited(self) -> int:
        return sum(frontier.size for frontier in self.frontiers)

    def step(self) -> bool:
        """One hop; whether it met any node that was not visited."""
        here, there, last = self.here, self.there, self.frontiers[-1]
        ids = last.nodes.select(F.col("nodeId").alias(here))
        with fixed_layout(self.spark, self.partitions):
            leaving = self.usual.join(F.broadcast(ids) if last.small else ids, here, "left_semi")
            if self.spread is not None:
                few = ids if last.small else ids.join(self.hubs, here, "left_semi")
                met = self.spread.join(F.broadcast(few), here, "left_semi")
                leaving = leaving.unionByName(met)
            node = F.col(there).alias("nodeId")
            if self.ways:
                targets = leaving.groupBy(node).agg(F.min(here).alias("via"))
            else:
                targets = leaving.select(node).distinct()
            visited = reduce(DataFrame.union, (x.nodes.select("nodeId") for x in self.frontiers))
            frontier = _Frontier.of(targets.join(visited, "nodeId", "left_anti"))
        if frontier.size:
            self.frontiers.append(frontier)
        return frontier.size > 0

    def release(self) -> None:
        self.usual.unpersist()
        if self.spread is not None:
            self.spread.unpersist()


def _counted(edges: Edges) -> tuple[CountedEdges, str | None]:
    return (edges, None) if isinstance(edges, CountedEdges) else store_counted(edges)


def _walked(
    edges: Edges, starts: DataFrame, hops: int, back: bool, rows_per_slice: int, ways: bool
) -> list[DataFrame]:
    """The frontiers of up to ``hops`` hops, with ``via`` if ``ways`` are wanted."""
    if hops < 0:
        raise ValueError("hops must be at least 0")
    counted, path = _counted(edges)
    walk = _Walk(counted, starts, back, rows_per_slice, ways)
    for _ in range(hops):
        if not walk.frontiers[-1].size or not walk.step():
            break
    walk.release()
    if path:
        drop_scratch(edges.sparkSession, path)
    return [frontier.nodes for frontier in walk.frontiers]


def _hop(number: int) -> Column:
    return F.lit(number).cast("bigint").alias("hop")


def trace(
    edges: Edges,
    starts: DataFrame,
    hops: int,
    back: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """(nodeId, hop) with the smallest hop, starts (column nodeId) at 0; ``back`` goes upstream.

    An empty frontier ends the walk.
    """
    frontiers = _walked(edges, starts, hops, back, rows_per_slice, ways=False)
    placed = (nodes.select("nodeId", _hop(hop)) for hop, nodes in enumerate(frontiers))
    return reduce(DataFrame.unionByName, placed)


def trace_paths(
    edges: Edges,
    starts: DataFrame,
    hops: int,
    back: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """(nodeId, hop, path): the same with a shortest way from a start, as an array of ids.

    Among equally short ways a node is reached from the least id (as text) of the hop before, and
    so on back to the start. Each hop's table of nodes before is unrolled on that of the hop before it.
    """
    frontiers = _walked(edges, starts, hops, back, rows_per_slice, ways=True)
    paths = [frontiers[0].select("nodeId", F.array("nodeId").alias("path"))]
    for nodes in frontiers[1:]:
        before = paths[-1].select(F.col("nodeId").alias("via"), F.col("path").alias("before"))
        way = F.concat("before", F.array("nodeId")).alias("path")
        paths.append(checkpoint(nodes.join(before, "via").select("nodeId", way)))
    placed = (nodes.select("nodeId", _hop(hop), "path") for hop, nodes in enumerate(paths))
    return reduce(DataFrame.unionByName, placed)


def _way(frontiers: list[_Frontier], node: str) -> list[str]:
    """From a start to a node of the last frontier, a look-up for each hop."""
    way = [node]
    for frontier in reversed(frontiers[1:]):
        found = frontier.nodes.where(F.col("nodeId") == F.lit(way[-1])).first()
        way.append(found["via"])
    return way[::-1]


def connection(
    edges: Edges,
    source: str,
    target: str,
    most_hops: int,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """One row (source, target, distance, path, visited) if a way of at most ``most_hops`` leads there.

    Two walks, from the source along the links and from the target against them; each time the one
    with the smaller frontier takes a hop, until a new frontier meets the other walk's last. ``path`` is
    a shortest way, through the least id where they meet; ``visited`` counts the nodes of both walks.
    No way, or an id that no edge has, gives no row; a node is at distance 0 from itself.
    """
    if most_hops < 0:
        raise ValueError("most_hops must be at least 0")
    spark, ends = edges.sparkSession, (str(source), str(target))
    counted, path = _counted(edges)

    def start(node: str) -> DataFrame:
        known = counted.rows.where((F.col("src") == F.lit(node)) | (F.col("dst") == F.lit(node)))
        return known.limit(1).select(F.lit(node).alias("nodeId"))

    walks = [
        _Walk(counted, start(node), back, rows_per_slice)
        for node, back in zip(ends, (False, True), strict=True)
    ]
    found = None
    while all(walk.frontiers[-1].size for walk in walks):
        here, there = (walk.frontiers[-1].nodes.select("nodeId") for walk in walks)
        met = here.join(there, "nodeId", "left_semi").agg(F.min("nodeId").alias("node")).first()
        if met["node"] is not None:
            found = met["node"]
            break
        if sum(len(walk.frontiers) - 1 for walk in walks) == most_hops:
            break
        smaller = min(walks, key=lambda walk: walk.frontiers[-1].size)
        if not smaller.step():
            break
    rows = []
    if found is not None:
        first, last = (_way(walk.frontiers, found) for walk in walks)
        way = [*first, *last[-2::-1]]
        rows = [(*ends, len(way) - 1, way, sum(walk.visited for walk in walks))]
    for walk in walks:
        walk.release()
    if path:
        drop_scratch(spark, path)
    schema = "source string, target string, distance bigint, path array<string>, visited bigint"
    return spark.createDataFrame(rows, schema)


def trace_each(edges: Edges, starts: DataFrame, hops: int, back: bool = False) -> DataFrame:
    """(start, nodeId, hop): what ``trace`` gives for each start (column nodeId) alone.

    All starts walk together: a node carries the set of starts that reach it as bitmaps of
    ``STARTS_PER_WORD`` starts, which an aggregate merges, so an edge is crossed once in a hop for
    each word of starts and not once for each start.
    """
    if hops < 0:
        raise ValueError("hops must be at least 0")
    here, there = ("dst", "src") if back else ("src", "dst")
    counted, path = _counted(edges)
    links = counted.rows.select(here, F.col(there).alias("_there"))
    number = F.monotonically_increasing_id().alias("number")  # fixed once it is stored
    wanted = starts.select(F.col("nodeId").cast("string").alias("start")).distinct()
    numbered, _ = store(wanted.select("start", number), "starts")
    frontier = checkpoint(
        numbered.select(
            F.col("start").alias("nodeId"),
            F.expr(f"number div {STARTS_PER_WORD}").alias("word"),
            F.expr(f"shiftleft(1L, cast(number % {STARTS_PER_WORD} as int))").alias("bits"),
        )
        .groupBy("nodeId", "word")
        .agg(F.bit_or("bits").alias("bits"))
    )
    met = [frontier]
    for _ in range(hops):
        reached = (
            links.join(frontier.withColumnRenamed("nodeId", here), here)
            .groupBy(F.col("_there").alias("nodeId"), "word")
            .agg(F.bit_or("bits").alias("bits"))
        )
        seen = reduce(DataFrame.union, met).groupBy("nodeId", "word")
        seen = seen.agg(F.bit_or("bits").alias("seen"))
        new = F.expr("bits & ~coalesce(seen, 0L)").alias("bits")
        frontier = reached.join(seen, ["nodeId", "word"], "left").select("nodeId", "word", new)
        frontier = checkpoint(frontier.where("bits != 0"))
        if frontier.isEmpty():
            break
        met.append(frontier)
    if path:
        drop_scratch(edges.sparkSession, path)
    placed = reduce(DataFrame.unionByName, (x.withColumn("hop", _hop(k)) for k, x in enumerate(met)))
    bit = f"filter(sequence(0, {STARTS_PER_WORD - 1}), i -> getbit(bits, i) = 1)"
    each = placed.select(
        "nodeId", "hop", F.col("word"), F.explode(F.expr(bit)).alias("bit")
    ).withColumn("number", F.col("word") * STARTS_PER_WORD + F.col("bit"))
    return each.join(numbered, "number").select("start", "nodeId", "hop")
