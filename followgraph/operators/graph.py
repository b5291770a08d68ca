"""Graph statistics and follower rankings.

All vertex-level facts come from one aggregation over the edges: each
edge contributes a row for its source (one out-edge) and one for its
destination (one follower).  Partial aggregation runs before the
shuffle, so a user followed by a third of the graph sends one row per
map task, not one per follower.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from followgraph.operators import lineage, skew


def _ends(edges: DataFrame, weight: Column) -> DataFrame:
    """Both ends of every edge in one pass: ``userId, o, i`` with ``o`` the
    weight for the source row and ``i`` for the destination row."""
    zero = F.lit(0).cast("long")
    return edges.select(
        F.inline(
            F.array(
                F.struct(F.col("source").alias("userId"), weight.alias("o"), zero.alias("i")),
                F.struct(F.col("destination").alias("userId"), zero.alias("o"), weight.alias("i")),
            )
        )
    )


def vertices(edges: DataFrame, weight: str | None = None) -> DataFrame:
    """``userId, out_degree, in_degree`` for every user in an edge.
    Repeated edges count every time, or by the column ``weight``; a
    self-loop counts on both sides."""
    one = F.lit(1).cast("long") if weight is None else F.col(weight)
    return _ends(edges, one).groupBy("userId").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))


def edge_count(edges: DataFrame) -> DataFrame:
    """G1: one row, ``edge_count`` (repeated edges included)."""
    return edges.agg(F.count(F.lit(1)).alias("edge_count"))


def all_users(edges: DataFrame) -> DataFrame:
    """Distinct ``userId`` over sources and destinations (one scan of
    the edges, both ends emitted by a generator, then a distinct)."""
    return edges.select(F.explode(F.array("source", "destination")).alias("userId")).distinct()


def vertex_count(users: DataFrame) -> DataFrame:
    """One row, ``vertex_count``."""
    return users.agg(F.count(F.lit(1)).alias("vertex_count"))


def graph_stats(edges: DataFrame) -> DataFrame:
    """Rows ``edge_count`` and ``vertex_count`` as ``metric, value``.

    One pass over the edges: the vertex aggregation gives the vertex count
    (rows) and the edge count (sum of out-degrees); a generator turns the
    one-row total into two rows.  Nothing goes through the driver."""
    totals = vertices(edges).agg(
        F.coalesce(F.sum("out_degree"), F.lit(0)).cast("long").alias("e"),
        F.count(F.lit(1)).alias("v"),
    )
    return totals.select(
        F.inline(
            F.array(
                F.struct(F.lit("edge_count").alias("metric"), F.col("e").alias("value")),
                F.struct(F.lit("vertex_count").alias("metric"), F.col("v").alias("value")),
            )
        )
    )


def follower_counts(edges: DataFrame) -> DataFrame:
    """``userId, followerCount`` for every user, zero included."""
    return vertices(edges).select("userId", F.col("in_degree").alias("followerCount"))


def top_followed(edges: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` most followed users; ties by ascending ``userId``.
    Planned as a per-partition top-n and a merge of ``n`` rows per task."""
    return follower_counts(edges).orderBy(F.desc("followerCount"), F.asc("userId")).limit(n)


def dangling_users(edges: DataFrame) -> DataFrame:
    """Users that follow nobody (they appear only as destinations)."""
    return vertices(edges).where(F.col("out_degree") == 0).select("userId")


ADJ_MAX_LIST = 1 << 16


def adjacency(
    edges: DataFrame,
    max_list: int = ADJ_MAX_LIST,
    min_rows: int = skew.HOT_MIN_ROWS,
    max_keys: int = skew.HOT_MAX_KEYS,
) -> DataFrame:
    """Followee lists: ``userId, part, followees, outDegree``.

    ``followees`` keeps repeated edges.  Repeated pairs are combined first
    and learn their source's out-degree ``n`` (a join that is salted for hot
    sources, see :mod:`followgraph.operators.skew`).  A list longer than
    ``max_list`` is dealt into ``ceil(n / max_list)`` groups by a hash of the
    followee, and each group is cut every ``max_list`` entries, so no row
    holds more, however often an edge repeats.  Other users have one row
    with ``part = 0``.  ``outDegree`` is the user's total over all parts.
    """
    pairs = edges.groupBy("source", "destination").agg(F.count(F.lit(1)).alias("c"))
    counts, m = lineage.materialize(
        pairs.groupBy("source").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("rows")), total=F.sum("rows")
    )
    total = int(m["total"] or 0)
    hot = skew.collect_hot(counts, "source", "rows", skew.hot_threshold(total, min_rows, max_keys), total, max_keys)
    known = counts.select("source", "n")
    if hot is None:
        sized = pairs.join(known, "source")
    else:
        sized = skew.add_salt(pairs, "source", "destination", hot).join(
            skew.replicate(known, "source", hot), ["source", "salt"]
        )
    size = F.lit(max_list)
    groups = F.ceil(F.col("n") / size)
    dealt = sized.withColumn("groups", groups).withColumn("g", F.pmod(F.xxhash64("destination"), "groups"))
    upto = W.partitionBy("source", "g").orderBy("destination").rowsBetween(W.unboundedPreceding, 0)
    placed = dealt.withColumn("last", F.sum("c").over(upto)).withColumn("first", F.col("last") - F.col("c"))
    cut = F.sequence(F.floor(F.col("first") / size), F.floor((F.col("last") - 1) / size))
    pieces = placed.withColumn("piece", F.explode(cut))
    copies = F.least("last", (F.col("piece") + 1) * size) - F.greatest("first", F.col("piece") * size)
    return (
        pieces.groupBy("source", "g", "piece")
        .agg(
            F.flatten(F.collect_list(F.array_repeat("destination", copies.cast("int")))).alias("followees"),
            F.max("n").alias("outDegree"),
            F.max("groups").alias("groups"),
        )
        .select(
            F.col("source").alias("userId"),
            (F.col("piece") * F.col("groups") + F.col("g")).cast("int").alias("part"),
            "followees",
            "outDegree",
        )
    )
