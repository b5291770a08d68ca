"""DuckDB SQL for every registered query (tables are the driver's views).

The iterative ones are chains of ``AS MATERIALIZED`` common table
expressions built by string formatting: one CTE per round, each reading
only the round before.  They follow the specified semantics literally
(full state, every receiver, per-edge contributions), so they also check
the shortcuts the Spark plans take.
"""

from __future__ import annotations

DIGITS = 10
ITERATIONS = 10
TOP_N = 100

EDGES = (
    "SELECT o_custkey AS source, 2 * l_partkey AS destination "
    "FROM orders JOIN lineitem ON o_orderkey = l_orderkey"
)
TOPICS = (
    "SELECT o_custkey AS userId, "
    "CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS DOUBLE) AS games, "
    "CAST(count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS DOUBLE) AS movies, "
    "CAST(count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS DOUBLE) AS music "
    "FROM orders GROUP BY o_custkey"
)
USERS = "SELECT source AS userId FROM e UNION SELECT destination AS userId FROM e"
VERTS = (
    "SELECT userId, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree FROM ("
    "SELECT source AS userId, 1 AS o, 0 AS i FROM e UNION ALL "
    "SELECT destination AS userId, 0 AS o, 1 AS i FROM e) GROUP BY userId"
)


def _with(*ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS MATERIALIZED ({body})" for name, body in ctes)


def _rank_rounds(k: int, edges: str = EDGES) -> list[tuple[str, str]]:
    ctes = [
        ("e", edges),
        ("v", VERTS),
        ("n", "SELECT CAST(count(*) AS DOUBLE) AS n FROM v"),
        ("r0", "SELECT v.userId, v.out_degree, 1.0::DOUBLE / n.n AS rank FROM v CROSS JOIN n"),
    ]
    for i in range(1, k + 1):
        p = f"r{i - 1}"
        ctes.append(
            (
                f"c{i}",
                f"SELECT e.destination AS userId, sum(r.rank / r.out_degree) AS received "
                f"FROM e JOIN {p} r ON r.userId = e.source GROUP BY e.destination",
            )
        )
        ctes.append(
            (
                f"m{i}",
                f"SELECT coalesce(sum(rank) FILTER (WHERE out_degree = 0), 0.0::DOUBLE) AS mass FROM {p}",
            )
        )
        ctes.append(
            (
                f"r{i}",
                f"SELECT v.userId, v.out_degree, (1.0::DOUBLE - 0.85::DOUBLE) / n.n + 0.85::DOUBLE * "
                f"(coalesce(c.received, 0.0::DOUBLE) + m.mass / n.n) AS rank "
                f"FROM v CROSS JOIN n CROSS JOIN m{i} m LEFT JOIN c{i} c ON c.userId = v.userId",
            )
        )
    return ctes


def _state0(edges: str = EDGES, topics: str = TOPICS) -> list[tuple[str, str]]:
    return [
        ("e", edges),
        ("t", topics),
        ("u", USERS),
        (
            "tl",
            "SELECT userId, 'games' AS topic, games AS freq FROM t UNION ALL "
            "SELECT userId, 'movies', movies FROM t UNION ALL SELECT userId, 'music', music FROM t",
        ),
        (
            "s0",
            "SELECT u.userId, tp.topic, coalesce(tl.freq, 0.0::DOUBLE) AS freq, "
            "coalesce(tl.freq >= 3.0::DOUBLE, false) AS interested, "
            "coalesce(tl.freq, 0.0::DOUBLE) AS max_freq, u.userId AS max_user "
            "FROM u CROSS JOIN (VALUES ('games'), ('movies'), ('music')) tp(topic) "
            "LEFT JOIN tl ON tl.userId = u.userId AND tl.topic = tp.topic",
        ),
        ("de", "SELECT DISTINCT source, destination FROM e"),
    ]


def _offers(prev: str) -> str:
    return (
        "SELECT userId, topic, f AS offer_freq, mu AS offer_user FROM ("
        "SELECT de.destination AS userId, s.topic, s.max_freq AS f, s.max_user AS mu, "
        "row_number() OVER (PARTITION BY de.destination, s.topic "
        "ORDER BY s.max_freq DESC, s.max_user DESC) AS rn "
        f"FROM {prev} s JOIN de ON de.source = s.userId WHERE s.interested) WHERE rn = 1"
    )


def _rec_rounds(k: int, edges: str = EDGES, topics: str = TOPICS) -> list[tuple[str, str]]:
    ctes = _state0(edges, topics)
    for i in range(1, k + 1):
        p = f"s{i - 1}"
        ctes.append((f"o{i}", _offers(p)))
        ctes.append(
            (
                f"s{i}",
                "SELECT s.userId, s.topic, s.freq, s.interested, "
                "CASE WHEN o.offer_freq > s.max_freq THEN o.offer_freq ELSE s.max_freq END AS max_freq, "
                "CASE WHEN o.offer_freq > s.max_freq THEN o.offer_user ELSE s.max_user END AS max_user "
                f"FROM {p} s LEFT JOIN o{i} o ON o.userId = s.userId AND o.topic = s.topic",
            )
        )
    return ctes


#: What the loaders keep of the planted lines.
LOADED_EDGES = f"SELECT source, destination FROM ({EDGES.replace('AS destination', 'AS destination, l_linenumber')}) WHERE l_linenumber NOT IN (4, 5, 6, 7)"
LOADED_TOPICS = f"SELECT userId, games, movies, music FROM ({TOPICS}) WHERE NOT (games = 2 OR movies = 4 OR music = 5)"


def _recommended(k: int) -> str:
    return (
        " SELECT userId, postFrequency, topic, recommendedUserId FROM ("
        "SELECT userId, max_freq AS postFrequency, topic, max_user AS recommendedUserId, "
        "row_number() OVER (PARTITION BY userId ORDER BY max_freq DESC, max_user ASC, topic DESC) AS rn "
        f"FROM s{k} WHERE interested) WHERE rn = 1 AND postFrequency > 0"
    )


RAW_EDGES = (
    "SELECT CASE WHEN l_linenumber = 4 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS source, "
    "CASE WHEN l_linenumber = 5 THEN '' WHEN l_linenumber = 6 THEN NULL "
    "ELSE CAST(2 * l_partkey AS VARCHAR) END AS destination "
    "FROM orders JOIN lineitem ON o_orderkey = l_orderkey"
)
RAW_TOPICS = (
    "SELECT CAST(userId AS VARCHAR) AS userId, "
    "CASE WHEN games = 2 THEN '-1' ELSE CAST(CAST(games AS BIGINT) AS VARCHAR) END AS games, "
    "CASE WHEN movies = 4 THEN 'x' ELSE CAST(CAST(movies AS BIGINT) AS VARCHAR) END AS movies, "
    "CASE WHEN music = 5 THEN NULL ELSE CAST(CAST(music AS BIGINT) AS VARCHAR) END AS music FROM t"
)
NUM = "regexp_full_match({c}, '-?[0-9]+')"


def _clean_edges_sql() -> str:
    return (
        _with(("raw", RAW_EDGES))
        + " SELECT CAST(source AS BIGINT) AS source, CAST(destination AS BIGINT) AS destination FROM raw "
        + f"WHERE {NUM.format(c='source')} AND {NUM.format(c='destination')}"
    )


def _clean_topics_sql() -> str:
    checks = " AND ".join(
        f"{c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NOT NULL AND CAST({c} AS DOUBLE) >= 0"
        for c in ("games", "movies", "music")
    )
    return (
        _with(("t", TOPICS), ("raw", RAW_TOPICS))
        + " SELECT CAST(userId AS BIGINT) AS userId, CAST(games AS DOUBLE) AS games, "
        "CAST(movies AS DOUBLE) AS movies, CAST(music AS DOUBLE) AS music FROM raw "
        f"WHERE {NUM.format(c='userId')} AND {checks}"
    )


def oracle_sql() -> dict[str, str]:
    k = ITERATIONS
    rank_k = _with(*_rank_rounds(k))
    rank_1 = _with(*_rank_rounds(1))
    rec_k = _with(*_rec_rounds(k))
    return {
        "graph_stats": _with(("e", EDGES))
        + " SELECT 'edge_count' AS metric, count(*) AS value FROM e UNION ALL "
        f"SELECT 'vertex_count' AS metric, count(*) AS value FROM ({USERS})",
        "all_users": _with(("e", EDGES)) + f" {USERS}",
        "follower_counts": _with(("e", EDGES), ("v", VERTS))
        + " SELECT userId, in_degree AS followerCount FROM v",
        "top_followed": _with(("e", EDGES), ("v", VERTS))
        + f" SELECT userId, in_degree AS followerCount FROM v ORDER BY followerCount DESC, userId ASC LIMIT {TOP_N}",
        "adjacency": _with(("e", EDGES))
        + " SELECT source AS userId, 0 AS part, "
        "array_to_string(list_sort(list(destination)), ',') AS followees, count(*) AS outDegree "
        "FROM e GROUP BY source",
        "adjacency_parts": _with(("e", EDGES))
        + " SELECT source AS userId, array_to_string(list_sort(list(destination)), ',') AS followees, "
        "count(*) AS outDegree, true AS bounded FROM e GROUP BY source",
        "dangling_users": _with(("e", EDGES), ("v", VERTS)) + " SELECT userId FROM v WHERE out_degree = 0",
        "pagerank_contrib": rank_1
        + f" SELECT v.userId, round(coalesce(c1.received, 0.0::DOUBLE), {DIGITS}) AS contrib "
        "FROM v LEFT JOIN c1 ON c1.userId = v.userId",
        "dangling_mass": rank_1
        + f" SELECT round(coalesce(sum(rank) FILTER (WHERE out_degree = 0), 0.0::DOUBLE), {DIGITS}) AS dangling_mass FROM r1",
        "pagerank_k1": rank_1 + f" SELECT userId, round(rank, {DIGITS}) AS rank FROM r1",
        "pagerank": rank_k + f" SELECT userId, round(rank, {DIGITS}) AS rank FROM r{k}",
        "pagerank_salted": rank_k + f" SELECT userId, round(rank, {DIGITS}) AS rank FROM r{k}",
        "pagerank_top": rank_k
        + f" SELECT userId, round(rank, {DIGITS}) AS rank FROM r{k} ORDER BY rank DESC, userId ASC LIMIT {TOP_N}",
        "pagerank_mass_check": rank_k + f" SELECT round(sum(rank), {DIGITS}) AS rank_sum FROM r{k}",
        "interests": _with(("t", TOPICS))
        + " SELECT userId, topic, freq, freq >= 3.0::DOUBLE AS interested FROM ("
        "SELECT userId, 'games' AS topic, games AS freq FROM t UNION ALL "
        "SELECT userId, 'movies', movies FROM t UNION ALL SELECT userId, 'music', music FROM t)",
        "rec_initial_state": _with(*_state0())
        + " SELECT userId, topic, freq, interested, max_freq, max_user FROM s0",
        "rec_contrib": _with(*_state0(), ("o1", _offers("s0")))
        + " SELECT userId, topic, offer_freq, offer_user FROM o1",
        "rec_state_k1": _with(*_rec_rounds(1))
        + " SELECT userId, topic, freq, interested, max_freq, max_user FROM s1",
        "rec_state_k10": rec_k + f" SELECT userId, topic, freq, interested, max_freq, max_user FROM s{k}",
        "recommendations": rec_k + _recommended(k),
        "recommendations_salted": rec_k + _recommended(k),
        "clean_edges": _clean_edges_sql(),
        "clean_topics": _clean_topics_sql(),
        "load_edges": LOADED_EDGES,
        "load_edges_repartitioned": LOADED_EDGES,
        "load_topics": LOADED_TOPICS,
        "parquet_single": _with(("e", EDGES), ("v", VERTS))
        + " SELECT userId, in_degree AS followerCount, CAST(1 AS BIGINT) AS files FROM v "
        f"ORDER BY followerCount DESC, userId ASC LIMIT {TOP_N}",
        "job_network_stats": _with(("e", LOADED_EDGES), ("v", VERTS))
        + " SELECT 'edge_count' AS metric, count(*) AS value FROM e UNION ALL "
        "SELECT 'vertex_count' AS metric, count(*) AS value FROM v UNION ALL "
        "SELECT 'user ' || userId AS metric, in_degree AS value FROM "
        f"(SELECT userId, in_degree FROM v ORDER BY in_degree DESC, userId ASC LIMIT {TOP_N})",
        "job_pagerank": _with(*_rank_rounds(k, LOADED_EDGES))
        + f", t AS (SELECT userId FROM r{k} ORDER BY rank DESC, userId ASC LIMIT {TOP_N})"
        + f" SELECT userId, round(rank, {DIGITS}) AS rank, userId IN (SELECT userId FROM t) AS top FROM r{k}",
        "job_recommend": _with(*_rec_rounds(k, LOADED_EDGES, LOADED_TOPICS)) + _recommended(k),
        "parquet_roundtrip": _with(("e", EDGES)) + " SELECT source, destination FROM e",
    }
