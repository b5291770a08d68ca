"""One query per operator, over the graph the driver tables define.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names match the SQL in :mod:`followgraph.plans.oracle`.  Doubles
that come from floating arithmetic are rounded to 10 places on both
sides so that summation order cannot change a hash.
"""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from followgraph.jobs import network_stats
from followgraph.jobs import pagerank as pagerank_job
from followgraph.jobs import recommend as recommend_job
from followgraph.operators import graph, lineage
from followgraph.operators import pagerank as pr
from followgraph.operators import recommend as rc
from followgraph.sources import sinks, text
from followgraph.sources.schemas import TOPICS
from followgraph.sources.tables import DESTINATION_FACTOR, edges_from, table, topics_from

DIGITS = 10
ITERATIONS = 10
DAMPING = 0.85
TOP_N = 100


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for written inputs: the session's checkpoint folder.  A
    session in one process that names none gets a local one; a cluster must
    name one, since executors do not share the driver's disk."""
    try:
        return lineage.checkpoint_dir(spark).rstrip("/")
    except RuntimeError:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise
        return lineage.ensure_checkpoint_dir(spark, Path(tempfile.mkdtemp(prefix="fg-ckpt-")).as_uri()).rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _r(c: str) -> F.Column:
    return F.round(F.col(c), DIGITS).alias(c)


def q_graph_stats(spark, sf):
    return graph.graph_stats(edges_from(spark, sf))


def q_all_users(spark, sf):
    return graph.all_users(edges_from(spark, sf))


def q_follower_counts(spark, sf):
    return graph.follower_counts(edges_from(spark, sf))


def q_top_followed(spark, sf):
    return graph.top_followed(edges_from(spark, sf), TOP_N)


def q_adjacency(spark, sf):
    adj = graph.adjacency(edges_from(spark, sf))
    listed = F.array_join(F.transform(F.array_sort("followees"), lambda x: x.cast("string")), ",")
    return adj.select("userId", "part", listed.alias("followees"), "outDegree")


def q_dangling_users(spark, sf):
    return graph.dangling_users(edges_from(spark, sf))


def _graph(spark, sf) -> pr.LinkGraph:
    scratch_dir(spark)
    return pr.prepare(edges_from(spark, sf))


def q_adjacency_parts(spark, sf):
    """Lists cut into parts of at most 7 entries, united again."""
    adj = graph.adjacency(edges_from(spark, sf), max_list=7, min_rows=20)
    united = adj.groupBy("userId").agg(
        F.flatten(F.collect_list("followees")).alias("followees"),
        F.max("outDegree").alias("outDegree"),
        F.max(F.size("followees")).alias("longest"),
    )
    listed = F.array_join(F.transform(F.array_sort("followees"), lambda x: x.cast("string")), ",")
    return united.select("userId", listed.alias("followees"), "outDegree", (F.col("longest") <= 7).alias("bounded"))


def _kept(df: DataFrame, *releases) -> DataFrame:
    """The frame as a checkpoint, so that the tables it reads can go now."""
    out, _ = lineage.materialize(df)
    for release in releases:
        release()
    return out


def q_pagerank_contrib(spark, sf):
    g = _graph(spark, sf)
    received = pr.contributions(pr.initial_ranks(g), g)
    out = g.verts.join(received, "userId", "left").select(
        "userId", F.round(F.coalesce(F.col("received"), F.lit(0.0)), DIGITS).alias("contrib")
    )
    return _kept(out, g.release)


def _one_round(spark, sf) -> DataFrame:
    g = _graph(spark, sf)
    try:
        return pr.run(g, 1, DAMPING)[0]
    finally:
        g.release()


def q_dangling_mass(spark, sf):
    ranks = _one_round(spark, sf)
    return _kept(pr.dangling_mass(ranks).select(_r("dangling_mass")), lambda: lineage.release(ranks))


def q_pagerank_k1(spark, sf):
    ranks = _one_round(spark, sf)
    return _kept(ranks.select("userId", _r("rank")), lambda: lineage.release(ranks))


def q_pagerank(spark, sf):
    return pr.pagerank(edges_from(spark, sf), ITERATIONS, DAMPING).select("userId", _r("rank"))


def q_pagerank_salted(spark, sf):
    """The same with users of more than 20 links spread over salts."""
    return pr.pagerank(edges_from(spark, sf), ITERATIONS, DAMPING, min_rows=20).select("userId", _r("rank"))


def q_pagerank_top(spark, sf):
    ranks = pr.pagerank(edges_from(spark, sf), ITERATIONS, DAMPING).select("userId", _r("rank"))
    return pr.top_ranked(ranks, TOP_N)


def q_pagerank_mass_check(spark, sf):
    ranks = pr.pagerank(edges_from(spark, sf), ITERATIONS, DAMPING, validate=True)
    return ranks.agg(F.round(F.sum("rank"), DIGITS).alias("rank_sum"))


def q_interests(spark, sf):
    return rc.interests(topics_from(spark, sf))


def q_rec_initial_state(spark, sf):
    return rc.initial_state(edges_from(spark, sf), topics_from(spark, sf))


def q_rec_contrib(spark, sf):
    edges = edges_from(spark, sf)
    ed = rc.edge_degrees(edges)
    state = rc.initial_state(edges, topics_from(spark, sf), users=ed.degrees.select("userId"))
    tl = rc.prepare(ed, state, all_receivers=True)
    return _kept(rc.best_offers(state, tl), tl.release, ed.release)


def _full_state(spark, sf, rounds: int) -> DataFrame:
    edges = edges_from(spark, sf)
    state = rc.initial_state(edges, topics_from(spark, sf))
    out = rc.propagate(state, edges, rounds, all_receivers=True)
    return _kept(out.select("userId", "topic", "freq", "interested", "max_freq", "max_user"), lambda: lineage.release(out))


def q_rec_state_k1(spark, sf):
    return _full_state(spark, sf, 1)


def q_rec_state_k10(spark, sf):
    return _full_state(spark, sf, ITERATIONS)


def q_recommendations(spark, sf):
    return rc.recommendations(edges_from(spark, sf), topics_from(spark, sf), ITERATIONS)


def q_recommendations_salted(spark, sf):
    """The same with users of more than 20 edges spread over salts."""
    return rc.recommendations(edges_from(spark, sf), topics_from(spark, sf), ITERATIONS, min_rows=20)


# Planted bad values, chosen by the line number of the order line (1-7):
# the edge cleaning keeps numbers and drops the rest.
def raw_edge_strings(spark, sf) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", (F.col("l_partkey") * DESTINATION_FACTOR).alias("followed"), "l_linenumber"
    )
    j = orders.join(items, orders.o_orderkey == items.l_orderkey)
    ln = F.col("l_linenumber")
    src = F.when(ln == 4, F.lit("x")).otherwise(F.col("o_custkey").cast("string"))
    dst = (
        F.when(ln == 5, F.lit(""))
        .when(ln == 6, F.lit(None).cast("string"))
        .otherwise(F.col("followed").cast("string"))
    )
    return j.select(src.alias("source"), dst.alias("destination"), ln.alias("line"))


def raw_topic_strings(spark, sf) -> DataFrame:
    t = topics_from(spark, sf)
    games = F.when(F.col("games") == 2, F.lit("-1")).otherwise(F.col("games").cast("long").cast("string"))
    movies = F.when(F.col("movies") == 4, F.lit("x")).otherwise(F.col("movies").cast("long").cast("string"))
    music = F.when(F.col("music") == 5, F.lit(None).cast("string")).otherwise(
        F.col("music").cast("long").cast("string")
    )
    return t.select(F.col("userId").cast("string").alias("userId"), games.alias("games"), movies.alias("movies"), music.alias("music"))


def q_clean_edges(spark, sf):
    return text.clean_edges(raw_edge_strings(spark, sf).select("source", "destination"))


def q_clean_topics(spark, sf):
    return text.clean_topics(raw_topic_strings(spark, sf))


def _edge_lines(spark, sf) -> str:
    """Path of the edges written as TSV lines with planted bad lines."""
    path = new_path(spark, "load_edges")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", (F.col("l_partkey") * DESTINATION_FACTOR).alias("followed"), "l_linenumber"
    )
    j = orders.join(items, orders.o_orderkey == items.l_orderkey)
    s, d, ln = F.col("o_custkey").cast("string"), F.col("followed").cast("string"), F.col("l_linenumber")
    line = (
        F.when(ln == 3, F.concat_ws("\t", s, d, F.lit("9")))  # extra field: kept
        .when(ln == 4, F.concat_ws("\t", F.lit("x"), d))  # not a number
        .when(ln == 5, s)  # one field
        .when(ln == 6, F.concat_ws("\t", F.concat(F.lit(" "), s), d))  # leading space
        .when(ln == 7, F.concat(F.lit("# "), s))  # comment
        .otherwise(F.concat_ws("\t", s, d))
    )
    j.select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def q_load_edges(spark, sf):
    return text.read_edges(spark, _edge_lines(spark, sf))


def q_load_edges_repartitioned(spark, sf):
    """Dealt evenly over the number of partitions planned from the input size."""
    return text.read_edges(spark, _edge_lines(spark, sf), partitions="auto")


def _topic_lines(spark, sf) -> str:
    """Path of the topics written as TSV with a header line and planted bad lines."""
    path = new_path(spark, "load_topics")
    t = topics_from(spark, sf)
    f = {c: F.col(c).cast("long").cast("string") for c in ("userId",) + TOPICS}
    line = (
        F.when(F.col("games") == 2, F.concat_ws("\t", f["userId"], F.lit("-1"), f["movies"], f["music"]))
        .when(F.col("movies") == 4, F.concat_ws("\t", f["userId"], f["games"], F.lit(""), f["music"]))
        .when(F.col("music") == 5, F.concat_ws("\t", f["userId"], f["games"], f["movies"]))
        .otherwise(F.concat_ws("\t", f["userId"], f["games"], f["movies"], f["music"]))
    )
    header = spark.range(1).select(F.lit("userId  games   movies  music").alias("value"))
    header.unionByName(t.select(line.alias("value"))).write.mode("overwrite").text(path)
    return path


def q_load_topics(spark, sf):
    return text.read_topics(spark, _topic_lines(spark, sf))


def q_parquet_roundtrip(spark, sf):
    path = new_path(spark, "roundtrip")
    sinks.write_parquet(edges_from(spark, sf), path)
    return spark.read.parquet(path)


def q_parquet_single(spark, sf):
    """A bounded result as one file; its number of data files beside each row."""
    path = new_path(spark, "single")
    sinks.write_parquet_single(graph.top_followed(edges_from(spark, sf), TOP_N), path)
    out = spark.read.parquet(path)
    return out.withColumn("files", F.lit(len(out.inputFiles())).cast("long"))


def q_job_network_stats(spark, sf):
    out = new_path(spark, "job_stats")
    network_stats.run(spark, [_edge_lines(spark, sf), out, str(TOP_N)])
    stats = spark.read.parquet(f"{out}/graph-stats").select("metric", "value")
    top = spark.read.parquet(f"{out}/top-{TOP_N}-users")
    return stats.unionByName(top.select(F.concat(F.lit("user "), "userId").alias("metric"), F.col("followerCount").alias("value")))


def q_job_pagerank(spark, sf):
    out = new_path(spark, "job_pagerank")
    pagerank_job.run(spark, [_edge_lines(spark, sf), out, str(ITERATIONS), str(TOP_N)])
    top = spark.read.parquet(f"{out}/top-{TOP_N}-ranked-users").select("userId", F.lit(True).alias("top"))
    ranks = spark.read.parquet(f"{out}/pagerank-results").join(top, "userId", "left")
    return ranks.select("userId", _r("rank"), F.coalesce("top", F.lit(False)).alias("top"))


def q_job_recommend(spark, sf):
    out = new_path(spark, "job_recommend")
    recommend_job.run(spark, [_edge_lines(spark, sf), _topic_lines(spark, sf), out, str(ITERATIONS)])
    return spark.read.parquet(f"{out}/recommendations")


_PLANS = {
    "graph_stats": q_graph_stats,
    "all_users": q_all_users,
    "follower_counts": q_follower_counts,
    "top_followed": q_top_followed,
    "adjacency": q_adjacency,
    "adjacency_parts": q_adjacency_parts,
    "dangling_users": q_dangling_users,
    "pagerank_contrib": q_pagerank_contrib,
    "dangling_mass": q_dangling_mass,
    "pagerank_k1": q_pagerank_k1,
    "pagerank": q_pagerank,
    "pagerank_salted": q_pagerank_salted,
    "pagerank_top": q_pagerank_top,
    "pagerank_mass_check": q_pagerank_mass_check,
    "interests": q_interests,
    "rec_initial_state": q_rec_initial_state,
    "rec_contrib": q_rec_contrib,
    "rec_state_k1": q_rec_state_k1,
    "rec_state_k10": q_rec_state_k10,
    "recommendations": q_recommendations,
    "recommendations_salted": q_recommendations_salted,
    "clean_edges": q_clean_edges,
    "clean_topics": q_clean_topics,
    "load_edges": q_load_edges,
    "load_edges_repartitioned": q_load_edges_repartitioned,
    "load_topics": q_load_topics,
    "parquet_roundtrip": q_parquet_roundtrip,
    "parquet_single": q_parquet_single,
    "job_network_stats": q_job_network_stats,
    "job_pagerank": q_job_pagerank,
    "job_recommend": q_job_recommend,
}


def _with_scratch(fn):
    """Every query may checkpoint: make sure the session has a folder first."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        scratch_dir(spark)
        return fn(spark, sf)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES = {name: _with_scratch(fn) for name, fn in _PLANS.items()}
