"""Recompute the ranking as new edge files arrive."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from edgetide.operators.incremental import added_rank_edges
from edgetide.operators.stats import count_edges, graph_stats, store_counted
from edgetide.plans.job import run_job, save_version
from edgetide.schema import DAMPING, ITERATIONS
from edgetide.sources.edges import stream_edges
from edgetide.sources.results import drop_versions
from edgetide.storage import delete, numbered

_COUNTED = "src string, dst string, copies bigint"

MERGE_EVERY = 20
KEEP_VERSIONS = 10


def _known(session: SparkSession, edge_store: str, number: int) -> DataFrame:
    """All counted edges up to batch ``number``: the newest merged table before it, then batches."""
    merged = [n for n in numbered(session, edge_store, "upto") if n < number]
    base = max(merged, default=-1)
    paths = [f"{edge_store}/upto={base}"] if merged else []
    batches = numbered(session, edge_store, "batch")
    paths += [f"{edge_store}/batch={n}" for n in batches if base < n <= number]
    return session.read.schema(_COUNTED).parquet(*paths)


def _merge(session: SparkSession, edge_store: str, number: int) -> None:
    """One table in place of the batches so far; what the merge before it replaced goes.

    A merged table is used by later batches only, so a replay of this batch finds what it needs
    and writes the same table again.
    """
    earlier = [n for n in numbered(session, edge_store, "upto") if n < number]
    known = _known(session, edge_store, number)
    count_edges(known).write.mode("overwrite").parquet(f"{edge_store}/upto={number}")
    if earlier:
        last = max(earlier)
        for n in numbered(session, edge_store, "batch"):
            if n <= last:
                delete(session, f"{edge_store}/batch={n}")
        for n in earlier:
            if n < last:
                delete(session, f"{edge_store}/upto={n}")


def refresh_from_stream(
    spark: SparkSession,
    incoming: str,
    edge_store: str,
    out_dir: str,
    dataset_name: str,
    fmt: str = "tab",
    on_malformed: str = "fail",
    iterations: int = ITERATIONS,
    damping: float = DAMPING,
    every: str | None = "1 hour",
    files_per_trigger: int | None = None,
    merge_every: int = MERGE_EVERY,
    keep_versions: int = KEEP_VERSIONS,
    incremental: bool = False,
) -> StreamingQuery:
    """Add each batch of new files to ``edge_store`` and rank all edges so far.

    Edges are a multiset, so a batch that Spark replays after a failure must not count twice:
    it is stored under its batch number, and a replay overwrites that folder. The stream's own
    checkpoint lives in the store, which keeps the numbers and the folders together. Every
    ``merge_every`` batches are merged into one counted table, and of the saved results the newest
    ``keep_versions`` finished versions are kept. ``every`` None handles what is there now and
    stops.

    With ``incremental`` the ranks after every round are kept in the store, and a batch recomputes
    only the nodes whose input it changes; the saved results are the same.
    """
    edges = stream_edges(spark, incoming, fmt, on_malformed, files_per_trigger)

    def add_and_rank(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        count_edges(batch).write.mode("overwrite").parquet(f"{edge_store}/batch={number}")
        known = _known(session, edge_store, number)
        if incremental:
            new = session.read.schema(_COUNTED).parquet(f"{edge_store}/batch={number}")
            history = added_rank_edges(
                session, f"{edge_store}/history", new, number, iterations, damping
            )
            counted = store_counted(known)[0]
            save_version(
                history.ranks(number), counted, graph_stats(counted), out_dir, dataset_name,
                iterations, damping,
            )
        else:
            run_job(known, out_dir, dataset_name, iterations, damping)
        if (number + 1) % merge_every == 0:
            _merge(session, edge_store, number)
        drop_versions(session, out_dir, keep_versions)

    writer = edges.writeStream.foreachBatch(add_and_rank).option(
        "checkpointLocation", f"{edge_store}/_progress"
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
