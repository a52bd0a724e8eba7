"""The damped power iteration with a fixed number of rounds.

Only sources start with a rank, each with 1.0. A round replaces the rank table by the nodes
that received something; ranks of sinks are not redistributed and nothing is normalised.
Inside the rounds a rank table is (node*, pagerank) with the short keys of ``Links``.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgetide.functions.sums import order_free_sum
from edgetide.operators.links import Links, fixed_layout, prepare_links
from edgetide.operators.stats import Edges
from edgetide.schema import CHECKPOINT_EVERY, DAMPING, ITERATIONS
from edgetide.sources.rounds import Rounds
from edgetide.storage import checkpoint


def initial_ranks(links: Links) -> DataFrame:
    return links.sources.select(*_named(links, "src", "node"), F.lit(1.0).alias("pagerank"))


def _named(links: Links, old: str, new: str) -> list[Column]:
    names = zip(links.keys.names(old), links.keys.names(new), strict=True)
    return [F.col(name).alias(alias) for name, alias in names]


def _received(links: Links, ranks: DataFrame, result: Column) -> DataFrame:
    """One round: ``result`` over all that reaches a target, as (node*, result).

    The cached edges stay where they are. The rank table leaves the previous round's
    aggregation partitioned by node, which is the edges' partitioning; the few ranks of hot
    sources are broadcast to their links. Sums are combined before the one shuffle, unless next to
    no links of a target lie together and none is hot: then the rows go to their target as they are.
    """
    node = links.keys.names("node")
    meet = [F.col(a) == F.col(b) for a, b in zip(links.src, node, strict=True)]
    share = (F.col("pagerank") * F.col("weight")).alias("share")
    passed = [*_named(links, "dst", "node"), share]
    sent = links.edges.join(ranks, meet).select(*passed)
    if links.hot is not None:
        hot = F.broadcast(links.hot.select(*_named(links, "src", "node")))
        few = F.broadcast(ranks.join(hot, node, "left_semi"))
        sent = sent.unionByName(links.spread.join(few, meet).select(*passed))
    if not links.combine:
        sent = sent.repartition(links.partitions, *node)
    return sent.groupBy(*node).agg(result)


def _sum() -> Column:
    return order_free_sum(F.col("share"))


def contributions(links: Links, ranks: DataFrame) -> DataFrame:
    """What each target receives in one round: (node*, received)."""
    return _received(links, ranks, _sum().alias("received"))


def next_ranks(links: Links, ranks: DataFrame, damping: float = DAMPING) -> DataFrame:
    score = F.lit(1.0 - damping) + F.lit(float(damping)) * _sum()
    return _received(links, ranks, score.alias("pagerank"))


def with_ids(links: Links, table: DataFrame) -> DataFrame:
    """``table`` with ``nodeId`` in place of the short keys."""
    names = links.keys.names("node")
    ids = links.nodes.select("nodeId", *links.keys.of("nodeId", "node"))
    return ids.join(table, names).drop(*names)


def check_parameters(iterations: int, damping: float) -> None:
    if isinstance(iterations, bool) or not isinstance(iterations, int) or iterations < 0:
        raise ValueError("iterations must be an integer of at least 0")
    if not 0 <= damping <= 1:
        raise ValueError("damping must lie between 0 and 1")


def rank(
    links: Links,
    iterations: int = ITERATIONS,
    damping: float = DAMPING,
    checkpoint_every: int = CHECKPOINT_EVERY,
    rounds: Rounds | None = None,
) -> DataFrame:
    """Ranks (nodeId, pagerank) after exactly ``iterations`` rounds, checkpointed.

    The plan is cut every ``checkpoint_every`` rounds and at the end, so it stays short and a
    failure never goes back further than the last cut. With hot sources a round reads the ranks
    twice, so the plan is cut after each.

    With ``rounds``, which must be those of this graph and damping, the work starts from the furthest
    kept round and the cuts are kept there: more rounds later, or the same after a failure, cost only
    what is left.
    """
    check_parameters(iterations, damping)
    if checkpoint_every < 1:
        raise ValueError("checkpoint_every must be at least 1")
    spark, later = links.edges.sparkSession, links.after_first_round()
    done = rounds.last(iterations) if rounds else None
    ranks = initial_ranks(links) if done is None else rounds.read(done)
    for number in range((done or 0) + 1, iterations + 1):
        here = links if number == 1 else later
        # the later links' layout is another one: the ranks go there once
        moves = here.partitions != later.partitions and iterations > 1
        with fixed_layout(spark, here.partitions):
            ranks = next_ranks(here, ranks, damping)
            cut = number % checkpoint_every == 0
            if rounds and (cut or number == iterations):
                ranks = rounds.keep(ranks, number)
            elif (cut or links.hot is not None or moves) and number < iterations:
                ranks = checkpoint(ranks)
        if moves:
            ranks = ranks.repartition(later.partitions, *links.keys.names("node"))
    with fixed_layout(spark, (later if iterations > 1 else links).partitions):
        return checkpoint(with_ids(links, ranks))


def rank_edges(
    edges: Edges, iterations: int = ITERATIONS, damping: float = DAMPING
) -> DataFrame:
    """Ranks of an edge list; intermediate tables are dropped before returning."""
    check_parameters(iterations, damping)
    links = prepare_links(edges)
    try:
        return rank(links, iterations, damping)
    finally:
        links.release()
