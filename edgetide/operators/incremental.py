"""Ranks brought up to date with new edges, at the cost of what changes.

The ranks after every round are kept. New edges change the out-degree of their sources; in a round,
only targets of those sources, and of nodes whose rank changed in the round before, can receive
something else. These are recomputed from all their in-edges, the others keep their ranks. From the
round on in which a share of 1/``WIDE`` of all sources sends something else, all nodes are recomputed in
the layout of a full run, as finding and reading them edge by edge would take more.

    <folder>/state=<n>/edges       the edges that came with state n, counted
    <folder>/state=<n>/degrees     (src, out_degree) of all sources so far
    <folder>/state=<n>/round=<k>   (nodeId, pagerank) after round k
    <folder>/state=<n>/touched     (round, nodes, recomputed, edges_read), written last
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgetide.functions.sums import order_free_sum
from edgetide.operators.links import fixed_layout, prepare_links
from edgetide.operators.rank import check_parameters, initial_ranks, next_ranks, with_ids
from edgetide.operators.skew import ROWS_PER_SLICE, rows_matching
from edgetide.operators.stats import CountedEdges, Edges, store_counted
from edgetide.schema import DAMPING, ITERATIONS, RANKS
from edgetide.storage import checkpoint, delete, drop_scratch, finished, named

WIDE = 10

_EDGES = "src string, dst string, copies bigint"
_DEGREES = "src string, out_degree bigint"
_TOUCHED = "round bigint, nodes bigint, recomputed bigint, edges_read bigint"


@dataclass(frozen=True)
class RankHistory:
    """Numbered states of a growing graph, each with the ranks after every round.

    Edges are only ever added. Adding to state n makes state m > n; making a state again (a replayed
    batch) overwrites it and gives the same.
    """

    spark: SparkSession
    folder: str
    iterations: int = ITERATIONS
    damping: float = DAMPING

    def _path(self, number: int) -> str:
        return f"{self.folder}/state={number}"

    def states(self) -> list[int]:
        return sorted(int(n) for n in named(self.spark, self.folder, "state", "touched/_SUCCESS"))

    def _before(self, number: int) -> int | None:
        return max((n for n in self.states() if n < number), default=None)

    def edges(self, number: int) -> DataFrame:
        """All edges up to a state, counted by arrival: an edge may come in several rows."""
        paths = [f"{self._path(n)}/edges" for n in self.states() if n < number]
        return self.spark.read.schema(_EDGES).parquet(*paths, f"{self._path(number)}/edges")

    def round(self, number: int, k: int) -> DataFrame:
        return self.spark.read.schema(RANKS).parquet(f"{self._path(number)}/round={k}")

    def ranks(self, number: int) -> DataFrame:
        """The ranks (nodeId, pagerank) of a state."""
        return self.round(number, self.iterations)

    def touched(self, number: int) -> DataFrame:
        """(round, nodes, recomputed, edges_read): how many nodes there are, and the work done."""
        return self.spark.read.schema(_TOUCHED).parquet(f"{self._path(number)}/touched")

    def drop_rounds(self, number: int) -> None:
        """Delete the ranks of a state that no later one needs; its edges stay."""
        for k in range(self.iterations + 1):
            delete(self.spark, f"{self._path(number)}/round={k}")

    def _write(self, table: DataFrame, number: int, name: str) -> None:
        table.write.mode("overwrite").parquet(f"{self._path(number)}/{name}")

    def add(self, edges: Edges, number: int, rows_per_slice: int = ROWS_PER_SLICE) -> None:
        """Make state ``number`` from the newest one before it and ``edges``."""
        check_parameters(self.iterations, self.damping)
        counted, path = store_counted(edges)
        delete(self.spark, f"{self._path(number)}/touched")
        self._write(counted.rows, number, "edges")
        before = self._before(number)
        if before is None:
            touched = self._all_rounds(counted, number)
        else:
            touched = self._changed_rounds(counted, before, number, rows_per_slice)
        self._write(self.spark.createDataFrame(touched, _TOUCHED).coalesce(1), number, "touched")
        if path:
            drop_scratch(self.spark, path)

    def _all_rounds(self, counted: CountedEdges, number: int) -> list[tuple]:
        degrees = counted.rows.groupBy("src").agg(F.sum("copies").alias("out_degree"))
        self._write(degrees, number, "degrees")
        return self._full_rounds(counted, number, 0)

    def _full_rounds(self, counted: CountedEdges, number: int, first: int) -> list[tuple]:
        """Rounds ``first`` and later over all edges; the round before ``first`` is written already."""
        links = prepare_links(counted)
        if first:
            node = links.keys.of("nodeId", "node")
            ranks = self.round(number, first - 1).select(*node, "pagerank")
        else:
            ranks = initial_ranks(links)
        touched, read = [], counted.rows.count()
        with fixed_layout(self.spark, links.partitions):
            for k in range(first, self.iterations + 1):
                if k:
                    ranks = checkpoint(next_ranks(links, ranks, self.damping))
                self._write(with_ids(links, ranks), number, f"round={k}")
                nodes = self.round(number, k).count()
                touched.append((k, nodes, nodes, read if k else 0))
        links.release()
        return touched

    def _changed_rounds(
        self, new: CountedEdges, before: int, number: int, rows_per_slice: int
    ) -> list[tuple]:
        old_degrees = self.spark.read.schema(_DEGREES).parquet(f"{self._path(before)}/degrees")
        gained = new.rows.groupBy("src").agg(F.sum("copies").alias("out_degree"))
        degrees = old_degrees.unionByName(gained).groupBy("src").agg(
            F.sum("out_degree").alias("out_degree")
        )
        self._write(degrees, number, "degrees")
        degrees = self.spark.read.schema(_DEGREES).parquet(f"{self._path(number)}/degrees")
        every, sources = self.edges(number), checkpoint(gained.select("src"))
        # a node starts with a rank when it becomes a source
        ids = sources.select(F.col("src").alias("nodeId"))
        first = self.round(before, 0)
        started = checkpoint(ids.join(first, "nodeId", "left_anti"))
        self._write(
            first.unionByName(started.withColumn("pagerank", F.lit(1.0))), number, "round=0"
        )
        touched = [(0, self.round(number, 0).count(), started.count(), 0)]
        changed, many = started, degrees.count()
        for k in range(1, self.iterations + 1):
            senders = sources.unionByName(changed.select(F.col("nodeId").alias("src")))
            senders = checkpoint(senders.distinct())
            if senders.count() * WIDE >= many:
                counted, path = store_counted(every)
                touched += self._full_rounds(counted, number, k)
                drop_scratch(self.spark, path)
                return touched
            sent = rows_matching(every, senders, "src", rows_per_slice)
            targets = checkpoint(sent.select("dst").distinct())
            into = checkpoint(rows_matching(every, targets, "dst", rows_per_slice))
            scores = self.round(number, k - 1).withColumnRenamed("nodeId", "src")
            part = F.col("pagerank") * (F.col("copies") / F.col("out_degree"))
            total = order_free_sum(part)
            received = F.lit(1.0 - self.damping) + F.lit(float(self.damping)) * total
            fresh = checkpoint(
                into.join(scores, "src")
                .join(degrees, "src")
                .groupBy(F.col("dst").alias("nodeId"))
                .agg(received.alias("pagerank"))
            )
            old, ids = self.round(before, k), targets.select(F.col("dst").alias("nodeId"))
            kept = old.join(ids, "nodeId", "left_anti")
            self._write(kept.unionByName(fresh), number, f"round={k}")
            replaced = old.join(ids, "nodeId", "left_semi").withColumnRenamed("pagerank", "was")
            same = F.col("pagerank").eqNullSafe(F.col("was"))
            changed = checkpoint(
                fresh.join(replaced, "nodeId", "full").where(~same).select("nodeId")
            )
            nodes = self.round(number, k).count()
            touched.append((k, nodes, targets.count(), into.count()))
        return touched


def added_rank_edges(
    spark: SparkSession, folder: str, edges: Edges, number: int, iterations: int, damping: float
) -> RankHistory:
    """Add a batch to the history under ``folder``; ranks of states that are not needed go."""
    history = RankHistory(spark, folder, iterations, damping)
    if not finished(spark, f"{folder}/state={number}/touched"):
        history.add(edges, number)
    for state in history.states()[:-2]:
        history.drop_rounds(state)
    return history
