"""Counts, degrees and node sets of a graph.

Every operator takes plain edges (src, dst) or counted ones (src, dst, copies), where a row
stands for ``copies`` equal links and an edge may come in several rows.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgetide.storage import store


@dataclass(frozen=True)
class CountedEdges:
    """Edges (src, dst, copies) known to be text and distinct, which need no counting again."""

    rows: DataFrame

    def where(self, condition: Column) -> "CountedEdges":
        return CountedEdges(self.rows.where(condition))

    @property
    def sparkSession(self):  # noqa: N802, as on a DataFrame
        return self.rows.sparkSession


Edges = DataFrame | CountedEdges


def _id(end: str) -> Column:
    """An end of an edge as text; a null one fails the job."""
    missing = F.raise_error(F.lit(f"edge without {end}")).cast("string")
    return F.coalesce(F.col(end).cast("string"), missing)


def with_copies(edges: Edges) -> DataFrame:
    """Edges with text ids and a ``copies`` column; a plain edge row stands for one link."""
    if isinstance(edges, CountedEdges):
        return edges.rows
    copies = F.col("copies") if "copies" in edges.columns else F.lit(1)
    src, dst = (_id(end).alias(end) for end in ("src", "dst"))
    return edges.select(src, dst, copies.cast("bigint").alias("copies"))


def store_counted(edges: Edges) -> tuple[CountedEdges, str]:
    """The counted edges as a scratch table, and its path; reads ``edges`` once."""
    rows, path = store(count_edges(edges), "edges")
    return CountedEdges(rows), path


def count_edges(edges: Edges) -> DataFrame:
    """One row per distinct edge with its number of copies; combined before the shuffle."""
    if isinstance(edges, CountedEdges):
        return edges.rows
    return with_copies(edges).groupBy("src", "dst").agg(F.sum("copies").alias("copies"))


def nodes(edges: Edges) -> DataFrame:
    """Every id seen at either end, once: (nodeId)."""
    ends = F.array("src", "dst")
    return with_copies(edges).select(F.explode(ends).alias("nodeId")).distinct()


def node_degrees(edges: Edges) -> DataFrame:
    """(nodeId, out_degree, in_degree) for every node; one scan, one combined shuffle."""
    none = F.lit(0).cast("bigint")

    def end(node: str, out, into):
        return F.struct(F.col(node).alias("nodeId"), out.alias("sent"), into.alias("got"))

    copies = F.col("copies")
    ends = with_copies(edges).select(
        F.inline(F.array(end("src", copies, none), end("dst", none, copies)))
    )
    return ends.groupBy("nodeId").agg(
        F.sum("sent").alias("out_degree"), F.sum("got").alias("in_degree")
    )


def graph_stats(edges: Edges) -> DataFrame:
    """One row: total_edges (with copies), total_nodes, source_nodes."""
    return node_degrees(edges).agg(
        F.coalesce(F.sum("out_degree"), F.lit(0)).cast("bigint").alias("total_edges"),
        F.count(F.lit(1)).alias("total_nodes"),
        F.count_if(F.col("out_degree") > 0).alias("source_nodes"),
    )


def out_degree(edges: Edges) -> DataFrame:
    degree = F.sum("copies").alias("out_degree")
    return with_copies(edges).groupBy(F.col("src").alias("nodeId")).agg(degree)


def in_degree(edges: Edges) -> DataFrame:
    degree = F.sum("copies").alias("in_degree")
    return with_copies(edges).groupBy(F.col("dst").alias("nodeId")).agg(degree)


def sink_nodes(edges: Edges) -> DataFrame:
    """Nodes that link to nothing."""
    return node_degrees(edges).where(F.col("out_degree") == 0).select("nodeId")


def no_inlink_nodes(edges: Edges) -> DataFrame:
    """Nodes nothing links to."""
    return node_degrees(edges).where(F.col("in_degree") == 0).select("nodeId")
