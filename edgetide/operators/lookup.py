"""Look-ups by node. A node that is not found gives no row."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgetide.operators.adjacency import ENTRIES_PER_LIST, neighbor_lists
from edgetide.operators.skew import ROWS_PER_SLICE, fits_broadcast, rows_matching
from edgetide.operators.stats import CountedEdges, Edges
from edgetide.operators.topk import stored_list
from edgetide.functions.text import rounded
from edgetide.schema import STORED
from edgetide.sources.index import BucketedEdges
from edgetide.storage import checkpoint

# direction -> (column looked up, column listed, name of the list)
_DIRECTIONS = {"outgoing": ("src", "dst", "neighbors"), "incoming": ("dst", "src", "sources")}


def _searched(ranks: DataFrame, stored: int | None) -> DataFrame:
    if stored is not None:
        return stored_list(ranks, stored).drop("rank")
    return ranks.select("nodeId", rounded(F.col("pagerank")).alias("pagerank"))


def node_score(ranks: DataFrame, node_id: str, stored: int | None = STORED) -> DataFrame:
    """The score of one node among the best ``stored``; None searches the whole ranking."""
    return _searched(ranks, stored).where(F.col("nodeId") == F.lit(str(node_id)))


def node_scores(ranks: DataFrame, ids: DataFrame, stored: int | None = None) -> DataFrame:
    """The same for a table of ids (column nodeId), by default over the whole ranking."""
    wanted = ids.select(F.col("nodeId").cast("string")).distinct()
    found = _searched(ranks, stored)
    if stored is not None and stored <= STORED:
        return wanted.join(F.broadcast(found), "nodeId")
    return wanted.join(found, "nodeId")


def _report(edges: Edges, direction: str, limit: int) -> DataFrame:
    key, other, name = _DIRECTIONS[direction]
    return neighbor_lists(edges, key, other, limit).select(
        F.col(key).alias("nodeId"),
        F.lit(direction).alias("direction"),
        "count",
        "part",
        F.col("entries").alias(name),
    )


def _at(edges: Edges, key: str, node_id: str) -> Edges:
    node_id = str(node_id)
    if isinstance(edges, BucketedEdges):
        return edges.at(key, node_id)
    return edges.where(F.col(key) == F.lit(node_id))


def neighbors(edges: Edges, node_id: str, limit: int = ENTRIES_PER_LIST) -> DataFrame:
    """Whom a node links to: (nodeId, direction, count, part, neighbors)."""
    return _report(_at(edges, "src", node_id), "outgoing", limit)


def influenced_by(edges: Edges, node_id: str, limit: int = ENTRIES_PER_LIST) -> DataFrame:
    """Who links to a node: (nodeId, direction, count, part, sources)."""
    return _report(_at(edges, "dst", node_id), "incoming", limit)


def neighbors_of(
    edges: Edges,
    ids: DataFrame,
    direction: str = "outgoing",
    limit: int = ENTRIES_PER_LIST,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Neighbour lists for a table of ids (column nodeId), in either direction.

    In an index with buckets by that end, ids few enough to broadcast read their buckets only.
    """
    key = _DIRECTIONS[direction][0]
    wanted = checkpoint(ids.select(F.col("nodeId").cast("string").alias(key)).distinct())
    indexed = isinstance(edges, BucketedEdges) and edges.key == key
    if indexed and fits_broadcast(wanted, key):
        found = edges.at_all(wanted)
    elif isinstance(edges, CountedEdges):
        found = CountedEdges(rows_matching(edges.rows, wanted, key, rows_per_slice))
    else:
        found = rows_matching(edges, wanted, key, rows_per_slice)
    return _report(found, direction, limit)


def job_stats(metadata: DataFrame) -> DataFrame:
    """The saved metadata under its report names, defaults in place of missing values."""
    defaults = {
        "dataset": ("dataset_name", "string", "unknown"),
        "total_nodes": ("total_nodes", "bigint", 0),
        "total_edges": ("total_edges", "bigint", 0),
        "iterations": ("iterations", "bigint", 0),
        "damping_factor": ("damping_factor", "double", 0.0),
        "top_node": ("top_node", "string", ""),
        "completed_at": ("completed_at", "string", ""),
    }
    return metadata.select(
        *(
            F.coalesce(F.col(column), F.lit(default)).cast(kind).alias(name)
            for name, (column, kind, default) in defaults.items()
        )
    )
