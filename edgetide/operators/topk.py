"""Orderings and top lists. Scores are sorted first and rounded after; ties go by node id."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgetide.functions.text import rounded, ten_decimals
from edgetide.schema import STORED, TOP
from edgetide.storage import checkpoint

# A list of at most so many nodes is numbered in one task, a longer one by ranges.
IN_ONE_TASK = 100_000
_ROW_BITS = 33

_BEST_FIRST = (F.desc, "pagerank"), (F.asc, "nodeId")


def _order():
    return [direction(column) for direction, column in _BEST_FIRST]


def full_ranking(ranks: DataFrame) -> DataFrame:
    """All ranks, best first: a range-partitioned sort over (score, id)."""
    return ranks.orderBy(*_order())


def in_ranges(ranks: DataFrame) -> DataFrame:
    """(nodeId, pagerank, place): best first within and across partitions; one range shuffle.

    ``place`` holds the partition's number and, in the lower 33 bits, the row's within it.
    """
    ranged = ranks.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    return ranged.select("nodeId", "pagerank", F.monotonically_increasing_id().alias("place"))


def numbered(ranged: DataFrame) -> DataFrame:
    """(rank, nodeId, pagerank) of a materialised ``in_ranges`` table, in its order.

    A range's rows follow on those of the ranges before it; what is summed in one task and broadcast is
    one row for each range.
    """
    part = F.shiftright("place", _ROW_BITS).alias("part")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("rows"))
    starts = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    row = F.col("place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return ranged.select("*", part).join(F.broadcast(starts), "part").select(
        (F.col("before") + row + 1).alias("rank"), "nodeId", "pagerank"
    )


def all_places(ranks: DataFrame) -> DataFrame:
    """(rank, nodeId, pagerank) of every node, scores unrounded; no window over the nodes."""
    return numbered(checkpoint(in_ranges(ranks)))


def ranking_lines(ranks: DataFrame) -> DataFrame:
    """The ranking as text lines, best first; see ``lines``."""
    return lines(full_ranking(ranks))


def lines(ranking: DataFrame) -> DataFrame:
    """Rows of a ranking as text lines in the same order: node, tab, score with ten decimals.

    Line ends inside an id are written as ``\\n`` and ``\\r``, so that a node stays one line.
    """
    node = F.replace(F.replace("nodeId", F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    line = F.concat_ws("\t", node, ten_decimals(F.col("pagerank")))
    return ranking.select(line.alias("value"))


def stored_list(ranks: DataFrame, stored: int = STORED) -> DataFrame:
    """The best ``stored`` nodes with their place, scores rounded to eight places."""
    return top_list(ranks, stored)


def top_list(ranks: DataFrame, n: int = TOP) -> DataFrame:
    """The best ``n`` nodes with their place 1..n.

    A window numbers a list of at most ``IN_ONE_TASK`` nodes; a longer one is numbered by ranges.
    """
    if n > IN_ONE_TASK:
        best, place = all_places(ranks).where(F.col("rank") <= n), F.col("rank")
    else:
        best = ranks.orderBy(*_order()).limit(n)
        place = F.row_number().over(Window.orderBy(*_order())).cast("bigint")
    return best.select(
        place.alias("rank"), "nodeId", rounded(F.col("pagerank")).alias("pagerank")
    )


def _requested(n) -> int:
    try:
        n = int(str(n))
    except ValueError:
        raise ValueError("n must be an integer") from None
    if n < 1:
        raise ValueError("n must be at least 1")
    return n


def top_n(stored: DataFrame, n) -> DataFrame:
    """The first ``n`` rows of a stored list by place, or all of it if shorter: (nodeId, pagerank).

    Places come from the unrounded scores; rounded ones may tie and would change the order.
    """
    return stored.where(F.col("rank") <= _requested(n)).orderBy("rank").drop("rank")


def top_n_header(stored: DataFrame, n) -> DataFrame:
    """One row: requested, returned, and a note when fewer are stored than requested."""
    requested = _requested(n)
    available = F.count(F.lit(1))
    note = F.format_string("all %d stored nodes are listed", available)
    return stored.agg(
        F.lit(requested).cast("bigint").alias("requested"),
        F.least(F.lit(requested).cast("bigint"), available).alias("returned"),
        F.when(available < requested, note).alias("note"),
    )
