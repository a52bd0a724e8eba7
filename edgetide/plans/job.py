"""The whole job: rank an edge list and save the results as a new version."""

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from edgetide.operators.adjacency import ENTRIES_PER_LIST
from edgetide.operators.links import Links, prepare_links
from edgetide.operators.rank import check_parameters, rank
from edgetide.operators.stats import CountedEdges, Edges, store_counted
from edgetide.schema import DAMPING, ITERATIONS
from edgetide.sources.layout import fingerprint, open_links, save_links
from edgetide.sources.results import (
    holder_of, job_metadata, name_edges, read_results, write_edges, write_metadata, write_rankings,
)
from edgetide.sources.rounds import Rounds
from edgetide.storage import delete, drop_scratch


def new_version() -> str:
    """A name that sorts after all earlier ones."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S.%f}-{uuid.uuid4().hex[:8]}"


def kept_folder(out_dir: str, graph: str) -> str:
    """Where the layout and the rounds of a graph (its fingerprint) are kept."""
    return f"{out_dir}/kept/graph={graph}"


def forget_kept(spark: SparkSession, out_dir: str) -> None:
    """Delete all kept layouts and rounds; saved results do not need them."""
    delete(spark, f"{out_dir}/kept")


def save_version(
    ranks: DataFrame,
    counted: CountedEdges,
    sizes: DataFrame,
    out_dir: str,
    dataset_name: str,
    iterations: int,
    damping: float,
    completed_at: str | None = None,
    version: str | None = None,
    entries_per_list: int = ENTRIES_PER_LIST,
    holder: str | None = None,
) -> str:
    """Write a new version of the results, metadata last; returns its name.

    ``holder`` is an earlier version that holds the same edges' lists and index, which are not written again.
    """
    version = version or new_version()
    folder = f"{out_dir}/version={version}"
    write_rankings(ranks, folder)
    if holder is None:
        write_edges(counted, folder, entries_per_list)
    name_edges(ranks.sparkSession, folder, holder or version, entries_per_list)
    completed_at = completed_at or datetime.now(timezone.utc).isoformat()
    write_metadata(
        job_metadata(sizes, ranks, dataset_name, iterations, damping, completed_at), folder
    )
    return version


def _laid_out(counted: CountedEdges, folder: str | None) -> Links:
    """The graph's layout: the kept one, else prepared and, given a folder, kept."""
    if folder is None:
        return prepare_links(counted)
    links = open_links(counted.sparkSession, folder)
    if links is None:
        links = prepare_links(counted)
        save_links(links, folder)
    return links


def run_job(
    edges: Edges,
    out_dir: str,
    dataset_name: str,
    iterations: int = ITERATIONS,
    damping: float = DAMPING,
    completed_at: str | None = None,
    version: str | None = None,
    entries_per_list: int = ENTRIES_PER_LIST,
    keep: bool = False,
    holder: str | None = None,
) -> str:
    """Rank ``edges`` and save everything under ``out_dir``; returns the new version's name.

    The input is read once: all outputs come from its stored, counted edges. Readers go on
    seeing the previous version until the metadata, written last, is there. A failure leaves
    the previous version in place and is raised.

    With ``keep`` the graph's layout and some rounds' ranks are kept under ``out_dir`` by the graph's
    fingerprint. A later job with ``keep`` on the same edges joins in the kept layout, and one with
    the same damping does only the rounds that are missing, also after a failure. ``holder`` names an
    earlier version whose neighbour lists and index are of these edges.
    """
    check_parameters(iterations, damping)
    spark, path = edges.sparkSession, None
    counted = edges
    if not isinstance(edges, CountedEdges):
        counted, path = store_counted(edges)
    try:
        folder = kept_folder(out_dir, fingerprint(counted)) if keep else None
        links = _laid_out(counted, folder and f"{folder}/layout")
        try:
            rounds = Rounds(spark, f"{folder}/rounds", damping) if folder else None
            ranks = rank(links, iterations, damping, rounds=rounds)
            links.forget()
            return save_version(
                ranks, counted, links.sizes(), out_dir, dataset_name, iterations, damping,
                completed_at, version, entries_per_list, holder,
            )
        finally:
            links.release()
    finally:
        if path:
            drop_scratch(spark, path)


def rerun_job(
    spark: SparkSession,
    out_dir: str,
    iterations: int = ITERATIONS,
    damping: float = DAMPING,
    completed_at: str | None = None,
    version: str | None = None,
    entries_per_list: int = ENTRIES_PER_LIST,
) -> str:
    """Other parameters for the graph of a saved version (the newest); needs no edge files.

    Edges come from the version's index, layout and rounds from what is kept of the graph. Lists and
    index are those of the saved version, which stays as long as one that refers to it, unless
    ``entries_per_list`` differs.
    """
    saved = read_results(spark, out_dir, version)
    holder, entries = holder_of(spark, out_dir, saved.version)
    name = saved.metadata.first()["dataset_name"]
    return run_job(
        saved.outgoing, out_dir, name, iterations, damping, completed_at,
        entries_per_list=entries_per_list, keep=True,
        holder=holder if entries == entries_per_list else None,
    )
