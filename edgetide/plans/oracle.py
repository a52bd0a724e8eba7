"""The registered queries as plain SQL over the test tables."""

from edgetide.plans.queries import CLOSE_DAMPING, COMPLETED_AT, LIST_LIMIT, STARTS

# Raw edges, one row per link, as (src, dst).
GRAPHS = {
    "part_next": """
        SELECT CAST(l_partkey AS VARCHAR) AS src, CAST(following AS VARCHAR) AS dst
        FROM (
          SELECT l_partkey, lead(l_partkey) OVER (
            PARTITION BY l_orderkey
            ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate,
                     l_quantity, l_discount, l_tax) AS following
          FROM lineitem) AS ordered
        WHERE following IS NOT NULL""",
    "part_supp": """
        SELECT CAST(l_partkey AS VARCHAR) AS src, CAST(l_suppkey AS VARCHAR) AS dst
        FROM lineitem""",
    "nation_trade": """
        SELECT buyer.n_name AS src, seller.n_name AS dst
        FROM lineitem
        JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey
        JOIN supplier ON s_suppkey = l_suppkey
        JOIN nation AS buyer ON buyer.n_nationkey = c_nationkey
        JOIN nation AS seller ON seller.n_nationkey = s_nationkey""",
    "page_links": """
        SELECT url AS src, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS dst
        FROM pages""",
}

_PART = "CAST(l_partkey AS VARCHAR)"
_SUPP = "CAST(l_suppkey AS VARCHAR)"
_ORDER = "CAST(l_orderkey AS VARCHAR)"

# What the three readers make of the seven line forms, by l_linenumber.
GRAPHS["tab_lines"] = f"""
        SELECT CASE WHEN l_linenumber = 5 THEN {_PART} || ' ' ELSE {_PART} END AS src,
               CASE WHEN l_linenumber = 5 THEN ' ' || {_SUPP}
                    WHEN l_linenumber = 6 THEN '' ELSE {_SUPP} END AS dst
        FROM lineitem WHERE l_linenumber IN (1, 3, 5, 6)"""
GRAPHS["blank_lines"] = f"""
        SELECT {_PART} AS src, {_SUPP} AS dst
        FROM lineitem WHERE l_linenumber IN (1, 4, 5, 6)"""
GRAPHS["csv_lines"] = f"""
        SELECT CASE WHEN l_linenumber = 6 THEN {_PART} || ',' || {_ORDER}
                    ELSE {_PART} END AS src,
               {_SUPP} AS dst
        FROM lineitem WHERE l_linenumber IN (1, 3, 4, 6)"""


def _graph(graph: str) -> str:
    return f"WITH edges AS MATERIALIZED ({GRAPHS[graph]})"


def _ranked(graph: str, iterations: int = 10, damping: float = 0.85) -> str:
    """CTEs up to ``ranks`` (nodeId, score): every round over the raw edges."""
    steps = [
        _graph(graph),
        """degrees AS MATERIALIZED (
             SELECT src, count(*) AS out_degree FROM edges GROUP BY src)""",
        """ranks0 AS MATERIALIZED (
             SELECT src AS nodeId, CAST(1 AS DOUBLE) AS score FROM degrees)""",
    ]
    for i in range(1, iterations + 1):
        steps.append(
            f"""ranks{i} AS MATERIALIZED (
             SELECT edges.dst AS nodeId,
                    (1 - CAST({damping} AS DOUBLE))
                    + CAST({damping} AS DOUBLE) * sum(r.score / degrees.out_degree) AS score
             FROM edges
             JOIN ranks{i - 1} AS r ON r.nodeId = edges.src
             JOIN degrees ON degrees.src = edges.src
             GROUP BY edges.dst)"""
        )
    steps.append(f"ranks AS (SELECT nodeId, score FROM ranks{iterations})")
    return ",\n".join(steps)


def _scores(graph: str, iterations: int = 10, damping: float = 0.85) -> str:
    return f"""{_ranked(graph, iterations, damping)}
        SELECT nodeId, round(score, 8) AS pagerank FROM ranks"""


_BEST = "row_number() OVER (ORDER BY score DESC, nodeId)"


def _stored(graph: str, n: int = 1000, iterations: int = 10, damping: float = 0.85) -> str:
    return f"""{_ranked(graph, iterations, damping)}
        SELECT {_BEST} AS rank, nodeId, round(score, 8) AS pagerank
        FROM ranks ORDER BY score DESC, ranks.nodeId LIMIT {n}"""


def _top_n(graph: str, n: int, damping: float = 0.85) -> str:
    return f"""SELECT nodeId, pagerank FROM ({_stored(graph, n, damping=damping)})"""


def _top5(graph: str) -> str:
    return f"""{_ranked(graph)}
        SELECT {_BEST} AS rank, nodeId, round(score, 8) AS pagerank
        FROM ranks ORDER BY score DESC, ranks.nodeId LIMIT 5"""


def _header(graph: str, n: int) -> str:
    return f"""{_ranked(graph)}
        , available AS (SELECT least(1000, count(*)) AS n FROM ranks)
        SELECT CAST({n} AS BIGINT) AS requested, least({n}, n) AS returned,
               CASE WHEN n < {n}
                    THEN 'all ' || n || ' stored nodes are listed' END AS note
        FROM available"""


def _sizes(graph: str) -> str:
    return f"""{_graph(graph)}
        SELECT count(*) AS total_edges,
               (SELECT count(*) FROM (SELECT src FROM edges UNION SELECT dst FROM edges))
                 AS total_nodes,
               count(DISTINCT src) AS source_nodes
        FROM edges"""


def _lists(key: str, other: str, name: str, where: str = "TRUE") -> str:
    direction = "outgoing" if key == "src" else "incoming"
    return f"""
        SELECT {key} AS nodeId, '{direction}' AS direction, count(*) AS count,
               CAST(0 AS BIGINT) AS part, string_agg({other}, ',' ORDER BY {other}) AS {name}
        FROM edges WHERE {where} GROUP BY {key}"""


def _metadata(graph: str) -> str:
    return f"""{_ranked(graph)}
        SELECT '{graph}' AS dataset_name,
               (SELECT count(*) FROM (SELECT src FROM edges UNION SELECT dst FROM edges))
                 AS total_nodes,
               (SELECT count(*) FROM edges) AS total_edges,
               CAST(10 AS BIGINT) AS iterations, CAST(0.85 AS DOUBLE) AS damping_factor,
               (SELECT nodeId FROM ranks ORDER BY score DESC, ranks.nodeId LIMIT 1) AS top_node,
               '{COMPLETED_AT}' AS completed_at"""


def _trace(graph: str, hops: int, back: bool = False) -> str:
    here, there = ("dst", "src") if back else ("src", "dst")
    steps = [
        _graph(graph),
        f"met0 AS MATERIALIZED (SELECT min({here}) AS nodeId, CAST(0 AS BIGINT) AS hop FROM edges)",
    ]
    for i in range(1, hops + 1):
        steps.append(
            f"""met{i} AS MATERIALIZED (
             SELECT nodeId, hop FROM met{i - 1}
             UNION ALL
             SELECT DISTINCT {there} AS nodeId, CAST({i} AS BIGINT) AS hop FROM edges
             WHERE {here} IN (SELECT nodeId FROM met{i - 1} WHERE hop = {i - 1})
               AND {there} NOT IN (SELECT nodeId FROM met{i - 1}))"""
        )
    return ",\n".join(steps) + f"\nSELECT nodeId, hop FROM met{hops}"


def _trace_paths(graph: str, hops: int, back: bool = False) -> str:
    """Each node by its least neighbour in the hop before."""
    here, there = ("dst", "src") if back else ("src", "dst")
    steps = [
        _graph(graph),
        f"""met0 AS MATERIALIZED (
             SELECT min({here}) AS nodeId, CAST(0 AS BIGINT) AS hop, min({here}) AS path
             FROM edges)""",
    ]
    for i in range(1, hops + 1):
        steps.append(
            f"""met{i} AS MATERIALIZED (
             SELECT nodeId, hop, path FROM met{i - 1}
             UNION ALL
             SELECT {there} AS nodeId, CAST({i} AS BIGINT) AS hop,
                    arg_min(m.path, {here}) || ',' || {there} AS path
             FROM edges JOIN met{i - 1} AS m ON m.nodeId = {here} AND m.hop = {i - 1}
             WHERE {there} NOT IN (SELECT nodeId FROM met{i - 1}) GROUP BY {there})"""
        )
    return ",\n".join(steps) + f"\nSELECT nodeId, hop, path FROM met{hops}"


def _trace_each(graph: str, hops: int) -> str:
    steps = [
        _graph(graph),
        f"""met0 AS MATERIALIZED (
             SELECT src AS start, src AS nodeId, CAST(0 AS BIGINT) AS hop
             FROM (SELECT DISTINCT src FROM edges ORDER BY src LIMIT {STARTS}))""",
    ]
    for i in range(1, hops + 1):
        steps.append(
            f"""met{i} AS MATERIALIZED (
             SELECT start, nodeId, min(hop) AS hop FROM (
               SELECT start, nodeId, hop FROM met{i - 1}
               UNION ALL
               SELECT start, dst, CAST({i} AS BIGINT) FROM edges
               JOIN met{i - 1} ON nodeId = src AND hop = {i - 1})
             GROUP BY start, nodeId)"""
        )
    return ",\n".join(steps) + f"\nSELECT start, nodeId, hop FROM met{hops}"


def _connection(graph: str, hops: int) -> str:
    return f"""SELECT (SELECT min(src) FROM ({GRAPHS[graph]})) AS source, nodeId AS target,
                      hop AS distance
        FROM ({_trace(graph, hops)}) WHERE nodeId = (SELECT max(dst) FROM ({GRAPHS[graph]}))"""


_ROUNDTRIP = f"""{_ranked("part_supp")}
        , placed AS (SELECT nodeId, score, {_BEST} AS place FROM ranks)
        SELECT 'top' AS output, nodeId, round(score, 8) AS value FROM placed WHERE place <= 5
        UNION ALL
        SELECT 'stored', nodeId, round(score, 8) FROM placed WHERE place <= 1000
        UNION ALL
        SELECT 'ranking', nodeId, CAST(printf('%.10f', score) AS DOUBLE) FROM placed
        UNION ALL
        SELECT 'graph', src, CAST(count(*) AS DOUBLE) FROM edges GROUP BY src
        UNION ALL
        SELECT 'metadata', (SELECT nodeId FROM placed WHERE place = 1),
               CAST(count(*) AS DOUBLE) FROM edges"""

_SAVED_LOOKUPS = f"""{_ranked("part_supp")}
        , placed AS (SELECT nodeId, score, {_BEST} AS place FROM ranks)
        SELECT 'score' AS lookup, nodeId, round(score, 8) AS value
        FROM placed WHERE place <= 1000 AND nodeId = '5'
        UNION ALL
        SELECT 'top', nodeId, round(score, 8) FROM placed WHERE place <= 10
        UNION ALL
        SELECT 'neighbors', src, CAST(count(*) AS DOUBLE)
        FROM edges WHERE src = '100' GROUP BY src
        UNION ALL
        SELECT 'influenced_by', dst, CAST(count(*) AS DOUBLE)
        FROM edges WHERE dst = '5' GROUP BY dst
        UNION ALL
        SELECT 'stats', (SELECT nodeId FROM placed WHERE place = 1), CAST(count(*) AS DOUBLE)
        FROM (SELECT src FROM edges UNION SELECT dst FROM edges) AS ids"""

_BOTH_ENDS = "{key} IN (SELECT src FROM edges) AND {key} IN (SELECT dst FROM edges)"


def statements() -> dict[str, str]:
    return {
        "scan_tab_edges": GRAPHS["tab_lines"],
        "scan_ws_edges": GRAPHS["blank_lines"],
        "scan_gzip_edges": GRAPHS["tab_lines"],
        "scan_csv_edges": GRAPHS["csv_lines"],
        "graph_stats": _sizes("part_next"),
        "graph_stats_ws": _sizes("blank_lines"),
        "graph_stats_page_links": _sizes("page_links"),
        "nodes": f"""{_graph("page_links")}
            SELECT src AS nodeId FROM edges UNION SELECT dst FROM edges""",
        "out_degree": f"""{_graph("part_next")}
            SELECT src AS nodeId, count(*) AS out_degree FROM edges GROUP BY src""",
        "in_degree": f"""{_graph("part_supp")}
            SELECT dst AS nodeId, count(*) AS in_degree FROM edges GROUP BY dst""",
        "sink_nodes": f"""{_graph("page_links")}
            SELECT dst AS nodeId FROM edges EXCEPT SELECT src FROM edges""",
        "no_inlink_nodes": f"""{_graph("part_supp")}
            SELECT src AS nodeId FROM edges EXCEPT SELECT dst FROM edges""",
        "adjacency": f"""{_graph("part_next")}
            SELECT nodeId, part, neighbors FROM ({_lists("src", "dst", "neighbors")})""",
        "reverse_adjacency": f"""{_graph("page_links")}
            SELECT nodeId, part, sources FROM ({_lists("dst", "src", "sources")})""",
        "adjacency_parts": f"""{_graph("part_supp")}
            SELECT dst AS nodeId, (place - 1) // {LIST_LIMIT} AS part,
                   string_agg(src, ',' ORDER BY place) AS sources
            FROM (SELECT src, dst, row_number() OVER (PARTITION BY dst ORDER BY src) AS place
                  FROM edges)
            GROUP BY 1, 2""",
        "contributions": f"""{_graph("nation_trade")}
            SELECT dst AS nodeId, round(sum(CAST(1 AS DOUBLE) / out_degree), 8) AS received
            FROM edges
            JOIN (SELECT src, count(*) AS out_degree FROM edges GROUP BY src) USING (src)
            GROUP BY dst""",
        "rank_iter0": _scores("part_supp", 0),
        "rank_iter1": _scores("nation_trade", 1),
        "rank_iter2": _scores("part_supp", 2),
        "pagerank_10": _scores("part_next"),
        "pagerank_10_part_supp": _scores("part_supp"),
        "pagerank_10_nation_trade": _scores("nation_trade"),
        "pagerank_vanish": _scores("page_links"),
        "pagerank_page_links_1": _scores("page_links", 1),
        "pagerank_hot_sources": _scores("part_next", 3),
        "pagerank_d90": _scores("part_next", damping=0.9),
        "pagerank_it15": _scores("part_next", 15),
        "full_ranking": _scores("part_next"),
        "ranking_tsv_lines": f"""{_ranked("part_supp")}
            SELECT nodeId || chr(9) || printf('%.10f', score) AS value FROM ranks""",
        "top5": _top5("part_next"),
        "top5_nation_trade": _top5("nation_trade"),
        "top1000": _stored("part_next"),
        "top_n": _top_n("part_next", 50),
        "top_n_close": _top_n("part_next", 20, CLOSE_DAMPING),
        "top_n_close_saved": _top_n("part_next", 20, CLOSE_DAMPING),
        "top_n_capped": _header("part_supp", 5000),
        "all_places": f"""{_ranked("part_next")}
            SELECT {_BEST} AS rank, nodeId, round(score, 8) AS pagerank FROM ranks""",
        "top_n_header": _header("part_next", 10),
        "node_score": f"""WITH best AS ({_stored("part_supp")})
            SELECT nodeId, pagerank FROM best WHERE nodeId = '5'""",
        "node_score_full": f"{_scores('part_next')} WHERE nodeId = '100'",
        "node_score_by_id": f"{_scores('part_next')} WHERE nodeId = '1999'",
        "node_score_missing": f"{_scores('part_next')} WHERE nodeId = 'none'",
        "node_scores_batch": _scores("part_supp"),
        "node_scores_all": _scores("part_next"),
        "neighbors": _graph("part_next") + _lists("src", "dst", "neighbors", "src = '100'"),
        "influenced_by": _graph("part_supp") + _lists("dst", "src", "sources", "dst = '5'"),
        "neighbors_indexed": _graph("part_next")
        + _lists("src", "dst", "neighbors", "src = '100'"),
        "influenced_by_indexed": _graph("part_supp")
        + _lists("dst", "src", "sources", "dst = '5'"),
        "neighbors_batch": _graph("part_supp")
        + _lists("src", "dst", "neighbors", _BOTH_ENDS.format(key="src")),
        "influenced_by_batch": _graph("part_supp")
        + _lists("dst", "src", "sources", _BOTH_ENDS.format(key="dst")),
        "neighbors_batch_indexed": _graph("part_supp")
        + _lists("src", "dst", "neighbors", _BOTH_ENDS.format(key="src")),
        "influenced_by_batch_indexed": _graph("part_supp")
        + _lists("dst", "src", "sources", _BOTH_ENDS.format(key="dst")),
        "job_metadata": _metadata("part_next"),
        "stats": f"""WITH described AS ({_metadata("page_links")})
            SELECT dataset_name AS dataset, total_nodes, total_edges, iterations,
                   damping_factor, coalesce(top_node, '') AS top_node, completed_at
            FROM described""",
        "trace_2hop": _trace("part_supp", 2),
        "trace_3hop": _trace("part_next", 3),
        "trace_6hop": _trace("part_next", 6),
        "trace_back_2hop": _trace("page_links", 2, back=True),
        "trace_paths_3hop": _trace_paths("part_next", 3),
        "trace_paths_back": _trace_paths("page_links", 2, back=True),
        "trace_each_start": _trace_each("part_next", 2),
        "connection": _connection("part_next", 6),
        "connection_one_way": _connection("part_supp", 6),
        "roundtrip_results": _ROUNDTRIP,
        "saved_lookups": _SAVED_LOOKUPS,
        "rerun_results": _stored("part_supp", iterations=3, damping=0.9),
        "resumed_results": _stored("part_next", iterations=15),
        "refresh_from_stream": _stored("tab_lines"),
        "refresh_incremental": _stored("tab_lines"),
        "rank_in_batches": _scores("part_supp"),
    }
