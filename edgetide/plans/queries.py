"""The registered queries: name -> function of (session, table folder)."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgetide.functions.text import rounded, ten_decimals
from edgetide.operators import adjacency as lists
from edgetide.operators import lookup, stats, topk
from edgetide.operators.links import prepare_links
from edgetide.operators.rank import contributions, initial_ranks, rank, rank_edges, with_ids
from edgetide.operators.incremental import RankHistory
from edgetide.operators.stats import Edges, store_counted
from edgetide.operators.trace import connection, trace, trace_each, trace_paths
from edgetide.plans.job import rerun_job, run_job
from edgetide.schema import DAMPING, ITERATIONS
from edgetide.sources.edges import read_edges
from edgetide.sources.index import read_index, write_index
from edgetide.sources.results import job_metadata, read_results, write_by_id
from edgetide.sources.tables import GRAPHS, csv_lines, edge_lines
from edgetide.storage import scratch_path, store
from edgetide.streaming.refresh import refresh_from_stream

Query = Callable[[SparkSession, str], DataFrame]

# So small that all scores are equal once rounded.
CLOSE_DAMPING = 1e-9
# Makes the small tables' largest sources hot.
SMALL_SLICE = 8
LIST_LIMIT = 50
BUCKETS = 16
STARTS = 64
# What a part of the edges is: the rest comes as later batches.
BATCHES = 3

# Stands for the finishing time, a parameter, so that results repeat.
COMPLETED_AT = "2024-01-01T00:00:00+00:00"


def _joined(column: str):
    return F.array_join(column, ",").alias(column)


def _on_graph(graph: str, make: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: make(GRAPHS[graph](spark, sf_dir))


def _on_stored(graph: str, make: Callable[[DataFrame], DataFrame]) -> Query:
    """For operators that read the edges more than once: these are derived and stored first."""
    return lambda spark, sf_dir: make(store(GRAPHS[graph](spark, sf_dir), "edges")[0])


def _on_counted(graph: str, make: Callable[[Edges], DataFrame]) -> Query:
    """The same where the ranks are among them, which need the edges counted anyway."""
    return lambda spark, sf_dir: make(store_counted(GRAPHS[graph](spark, sf_dir))[0])


def _on_ranks(
    graph: str,
    make: Callable[[DataFrame], DataFrame],
    iterations: int = ITERATIONS,
    damping: float = DAMPING,
) -> Query:
    return _on_graph(graph, lambda edges: make(rank_edges(edges, iterations, damping)))


def _scores(ranks: DataFrame) -> DataFrame:
    return ranks.select("nodeId", rounded(F.col("pagerank")).alias("pagerank"))


def _scan(make_lines, fmt: str, **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "lines")
        make_lines(spark, sf_dir).write.text(path, **options)
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions")) if options else None
        return read_edges(spark, path, fmt, on_malformed="drop", partitions=partitions)

    return query


def _contributions(edges: DataFrame) -> DataFrame:
    links = prepare_links(edges)
    received = with_ids(links, contributions(links, initial_ranks(links)))
    return received.select("nodeId", rounded(F.col("received")).alias("received"))


def _degree_ids(edges: DataFrame) -> DataFrame:
    """Ids for the batch look-ups: every node that is both a source and a target."""
    degrees = stats.node_degrees(edges)
    return degrees.where("out_degree > 0 and in_degree > 0").select("nodeId")


def _first_source(edges: DataFrame) -> DataFrame:
    return edges.agg(F.min("src").alias("nodeId"))


def _first_target(edges: DataFrame) -> DataFrame:
    return edges.agg(F.min("dst").alias("nodeId"))


def _trace(hops: int, back: bool = False) -> Callable[[DataFrame], DataFrame]:
    first = _first_target if back else _first_source
    return lambda edges: trace(edges, first(edges), hops, back)


def _neighbors_batch(direction: str) -> Callable[[DataFrame], DataFrame]:
    name = "neighbors" if direction == "outgoing" else "sources"
    return lambda edges: lookup.neighbors_of(edges, _degree_ids(edges), direction).select(
        "nodeId", "direction", "count", "part", _joined(name)
    )


def _metadata(edges: Edges, dataset_name: str) -> DataFrame:
    sizes, ranks = stats.graph_stats(edges), rank_edges(edges)
    return job_metadata(sizes, ranks, dataset_name, ITERATIONS, DAMPING, COMPLETED_AT)


def _roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five outputs of a saved job, read back: (output, nodeId, value)."""
    out_dir = scratch_path(spark, "results")
    run_job(GRAPHS["part_supp"](spark, sf_dir), out_dir, "part_supp", completed_at=COMPLETED_AT)
    saved = read_results(spark, out_dir)

    def rows(df: DataFrame, output: str, value) -> DataFrame:
        return df.select(
            F.lit(output).alias("output"), "nodeId", value.cast("double").alias("value")
        )

    described = saved.metadata.withColumnRenamed("top_node", "nodeId")
    return (
        rows(saved.top, "top", F.col("pagerank"))
        .unionByName(rows(saved.stored, "stored", F.col("pagerank")))
        .unionByName(rows(saved.ranking, "ranking", ten_decimals(F.col("pagerank"))))
        .unionByName(rows(saved.graph, "graph", F.size("neighbors")))
        .unionByName(rows(described, "metadata", F.col("total_edges")))
    )


def _saved_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look-ups answered from saved results alone: (lookup, nodeId, value)."""
    out_dir = scratch_path(spark, "results")
    run_job(GRAPHS["part_supp"](spark, sf_dir), out_dir, "part_supp", completed_at=COMPLETED_AT)
    saved = read_results(spark, out_dir)

    def rows(df: DataFrame, name: str, value: str) -> DataFrame:
        return df.select(
            F.lit(name).alias("lookup"), "nodeId", F.col(value).cast("double").alias("value")
        )

    described = lookup.job_stats(saved.metadata).withColumnRenamed("top_node", "nodeId")
    return (
        rows(lookup.node_score(saved.stored, "5"), "score", "pagerank")
        .unionByName(rows(topk.top_n(saved.stored, 10), "top", "pagerank"))
        .unionByName(rows(lookup.neighbors(saved.outgoing, "100"), "neighbors", "count"))
        .unionByName(rows(lookup.influenced_by(saved.incoming, "5"), "influenced_by", "count"))
        .unionByName(rows(described, "stats", "total_nodes"))
    )


def _indexed(direction: str, find, node_id: str, name: str) -> Callable[[DataFrame], DataFrame]:
    """A look-up in the copy of the edges that is sorted for it."""

    def query(edges: DataFrame) -> DataFrame:
        spark = edges.sparkSession
        folder = scratch_path(spark, "index")
        write_index(edges, folder)
        found = find(read_index(spark, folder, direction), node_id)
        return found.select("nodeId", "direction", "count", "part", _joined(name))

    return query


def _rerun(graph: str, first: int, iterations: int, damping: float = DAMPING) -> Query:
    """A second job on the saved graph, with other parameters, replaces the results readers see."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        out_dir = scratch_path(spark, "results")
        run_job(GRAPHS[graph](spark, sf_dir), out_dir, graph, iterations=first, keep=True)
        rerun_job(spark, out_dir, iterations, damping)
        return read_results(spark, out_dir).stored

    return query


def _path_rows(paths: DataFrame) -> DataFrame:
    return paths.select("nodeId", "hop", F.array_join("path", ",").alias("path"))


def _connection(edges: DataFrame) -> DataFrame:
    """From the first node to the last one."""
    ends = edges.agg(F.min("src").alias("first"), F.max("dst").alias("last")).first()
    found = connection(edges, ends["first"], ends["last"], 6)
    return found.select("source", "target", "distance")


def _first_sources(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("nodeId")).distinct().orderBy("nodeId").limit(STARTS)


def _saved_score(ranks: DataFrame, node_id: str) -> DataFrame:
    """A look-up in the scores ordered by id."""
    spark, path = ranks.sparkSession, scratch_path(ranks.sparkSession, "by-id")
    write_by_id(ranks, path)
    return lookup.node_score(spark.read.parquet(path), node_id, stored=None)


def _neighbors_indexed(direction: str) -> Callable[[DataFrame], DataFrame]:
    """Look-ups for a table of ids in an index with buckets."""
    name = "neighbors" if direction == "outgoing" else "sources"

    def query(edges: DataFrame) -> DataFrame:
        spark, folder = edges.sparkSession, scratch_path(edges.sparkSession, "index")
        write_index(edges, folder, BUCKETS)
        index = read_index(spark, folder, direction, BUCKETS)
        found = lookup.neighbors_of(index, _degree_ids(edges), direction)
        return found.select("nodeId", "direction", "count", "part", _joined(name))

    return query


def _in_batches(edges: DataFrame) -> DataFrame:
    """The edges arrive in batches, and ranks are brought up to date by each."""
    spark = edges.sparkSession
    history = RankHistory(spark, scratch_path(spark, "history"))
    batch = F.pmod(F.xxhash64("src", "dst"), F.lit(BATCHES * BATCHES))
    for number in range(BATCHES):
        here = batch >= BATCHES - 1 if number == 0 else batch == number - 1
        history.add(edges.where(here), number)
    return _scores(history.ranks(BATCHES - 1))


def _refresh(spark: SparkSession, sf_dir: str, incremental: bool = False) -> DataFrame:
    """An edge list arrives as files, in several batches; the result is the last saved list."""
    incoming, edge_store, out_dir = (
        scratch_path(spark, label) for label in ("incoming", "store", "results")
    )
    edge_lines(spark, sf_dir).repartition(4).write.text(incoming)
    refresh_from_stream(
        spark, incoming, edge_store, out_dir, "lines", on_malformed="drop", every=None,
        files_per_trigger=2, incremental=incremental,
    ).awaitTermination()
    return read_results(spark, out_dir).stored


def _top_n_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top n from saved results whose scores are equal once rounded."""
    out_dir = scratch_path(spark, "results")
    run_job(GRAPHS["part_next"](spark, sf_dir), out_dir, "part_next", damping=CLOSE_DAMPING)
    return topk.top_n(read_results(spark, out_dir).stored, 20)


def _blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over the blank-separated reader."""
    return stats.graph_stats(_scan(edge_lines, "blank")(spark, sf_dir))


def _sliced(edges: DataFrame) -> DataFrame:
    """Ranks by way of hot sources: a few links are already too many for one place."""
    links = prepare_links(edges, rows_per_slice=SMALL_SLICE)
    return _scores(rank(links, iterations=3))


def registered() -> dict[str, Query]:
    return {
        "scan_tab_edges": _scan(edge_lines, "tab"),
        "scan_ws_edges": _scan(edge_lines, "blank"),
        "scan_gzip_edges": _scan(edge_lines, "tab", compression="gzip"),
        "scan_csv_edges": _scan(csv_lines, "csv"),
        "graph_stats": _on_graph("part_next", stats.graph_stats),
        "graph_stats_ws": _blank_lines,
        "graph_stats_page_links": _on_graph("page_links", stats.graph_stats),
        "nodes": _on_graph("page_links", stats.nodes),
        "out_degree": _on_graph("part_next", stats.out_degree),
        "in_degree": _on_graph("part_supp", stats.in_degree),
        "sink_nodes": _on_graph("page_links", stats.sink_nodes),
        "no_inlink_nodes": _on_graph("part_supp", stats.no_inlink_nodes),
        "adjacency": _on_stored(
            "part_next",
            lambda edges: lists.adjacency(edges).select("nodeId", "part", _joined("neighbors")),
        ),
        "reverse_adjacency": _on_stored(
            "page_links",
            lambda edges: lists.reverse_adjacency(edges).select(
                "nodeId", "part", _joined("sources")
            ),
        ),
        "adjacency_parts": _on_stored(
            "part_supp",
            lambda edges: lists.reverse_adjacency(edges, LIST_LIMIT).select(
                "nodeId", "part", _joined("sources")
            ),
        ),
        "contributions": _on_stored("nation_trade", _contributions),
        "rank_iter0": _on_ranks("part_supp", _scores, iterations=0),
        "rank_iter1": _on_ranks("nation_trade", _scores, iterations=1),
        "rank_iter2": _on_ranks("part_supp", _scores, iterations=2),
        "pagerank_10": _on_ranks("part_next", _scores),
        "pagerank_10_part_supp": _on_ranks("part_supp", _scores),
        "pagerank_10_nation_trade": _on_ranks("nation_trade", _scores),
        "pagerank_vanish": _on_ranks("page_links", _scores),
        "pagerank_page_links_1": _on_ranks("page_links", _scores, iterations=1),
        "pagerank_hot_sources": _on_stored("part_next", _sliced),
        "pagerank_d90": _on_ranks("part_next", _scores, damping=0.9),
        "pagerank_it15": _on_ranks("part_next", _scores, iterations=15),
        "full_ranking": _on_ranks("part_next", lambda r: _scores(topk.full_ranking(r))),
        "ranking_tsv_lines": _on_ranks("part_supp", topk.ranking_lines),
        "top5": _on_ranks("part_next", topk.top_list),
        "top5_nation_trade": _on_ranks("nation_trade", topk.top_list),
        "top1000": _on_ranks("part_next", topk.stored_list),
        "top_n": _on_ranks("part_next", lambda r: topk.top_n(topk.stored_list(r), 50)),
        "top_n_close": _on_ranks(
            "part_next", lambda r: topk.top_n(topk.stored_list(r), 20), damping=CLOSE_DAMPING
        ),
        "top_n_close_saved": _top_n_saved,
        "top_n_capped": _on_ranks(
            "part_supp", lambda r: topk.top_n_header(topk.stored_list(r), 5000)
        ),
        "all_places": _on_ranks(
            "part_next",
            lambda r: topk.all_places(r).select(
                "rank", "nodeId", rounded(F.col("pagerank")).alias("pagerank")
            ),
        ),
        "top_n_header": _on_ranks(
            "part_next", lambda r: topk.top_n_header(topk.stored_list(r), "10")
        ),
        "node_score": _on_ranks("part_supp", lambda r: lookup.node_score(r, "5")),
        "node_score_full": _on_ranks(
            "part_next", lambda r: lookup.node_score(r, "100", stored=None)
        ),
        "node_score_by_id": _on_ranks("part_next", lambda r: _saved_score(r, "1999")),
        "node_score_missing": _on_ranks("part_next", lambda r: lookup.node_score(r, "none")),
        "node_scores_batch": _on_counted(
            "part_supp", lambda e: lookup.node_scores(rank_edges(e), stats.nodes(e))
        ),
        "node_scores_all": _on_counted(
            "part_next", lambda e: lookup.node_scores(rank_edges(e), stats.nodes(e))
        ),
        "neighbors": _on_graph(
            "part_next",
            lambda edges: lookup.neighbors(edges, "100").select(
                "nodeId", "direction", "count", "part", _joined("neighbors")
            ),
        ),
        "influenced_by": _on_graph(
            "part_supp",
            lambda edges: lookup.influenced_by(edges, "5").select(
                "nodeId", "direction", "count", "part", _joined("sources")
            ),
        ),
        "neighbors_indexed": _on_stored(
            "part_next", _indexed("outgoing", lookup.neighbors, "100", "neighbors")
        ),
        "influenced_by_indexed": _on_stored(
            "part_supp", _indexed("incoming", lookup.influenced_by, "5", "sources")
        ),
        "neighbors_batch": _on_stored("part_supp", _neighbors_batch("outgoing")),
        "influenced_by_batch": _on_stored("part_supp", _neighbors_batch("incoming")),
        "neighbors_batch_indexed": _on_stored("part_supp", _neighbors_indexed("outgoing")),
        "influenced_by_batch_indexed": _on_stored("part_supp", _neighbors_indexed("incoming")),
        "job_metadata": _on_counted("part_next", lambda e: _metadata(e, "part_next")),
        "stats": _on_counted(
            "page_links", lambda e: lookup.job_stats(_metadata(e, "page_links"))
        ),
        "trace_2hop": _on_stored("part_supp", _trace(2)),
        "trace_3hop": _on_stored("part_next", _trace(3)),
        "trace_6hop": _on_stored("part_next", _trace(6)),
        "trace_back_2hop": _on_stored("page_links", _trace(2, back=True)),
        "trace_paths_3hop": _on_stored(
            "part_next", lambda e: _path_rows(trace_paths(e, _first_source(e), 3))
        ),
        "trace_paths_back": _on_stored(
            "page_links", lambda e: _path_rows(trace_paths(e, _first_target(e), 2, back=True))
        ),
        "trace_each_start": _on_stored(
            "part_next", lambda e: trace_each(e, _first_sources(e), 2)
        ),
        "connection": _on_stored("part_next", _connection),
        "connection_one_way": _on_stored("part_supp", _connection),
        "roundtrip_results": _roundtrip,
        "saved_lookups": _saved_lookups,
        "rerun_results": _rerun("part_supp", ITERATIONS, 3, 0.9),
        "resumed_results": _rerun("part_next", ITERATIONS, 15),
        "refresh_from_stream": _refresh,
        "refresh_incremental": lambda spark, sf_dir: _refresh(spark, sf_dir, incremental=True),
        "rank_in_batches": _on_stored("part_supp", _in_batches),
    }
