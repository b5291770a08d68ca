"""Topic recommendations by interest-gated max propagation.

State is long-form, one row per ``(userId, topic)``: the user's own
frequency, whether it is an interest (``freq >= 3.0``), and the best
``(max_freq, max_user)`` seen so far.  In a round every follower that is
interested in a topic offers its best to each user it follows; a
receiver keeps the offer with the highest frequency (then the highest
user id) when it beats its own strictly.  After ``k`` rounds each user
gets the best of its interested topics (frequency, then the *lowest*
user id, then the topic name descending).

Exact shortcuts keep rounds cheap:

* rows are numbered once in the order of ``(freq, userId)``, and rounds
  carry that number instead of the user: the best offer is then the largest
  number, which a hash aggregation finds, and its user is looked up at the end;
* rows of topics a user is not interested in neither send nor get
  picked, so the default state holds interested rows only and the links
  join an interested follower to an interested followee
  (``all_receivers=True`` keeps every row, as the full state table);
* a round only needs the rows that improved in the round before: an
  offer seen earlier can never win later, because ``max_freq`` only
  rises and a receiver keeps its value on ties.  Rounds stop early when
  nothing improved, which gives the same result as running all of them.

The edges are read once and written as distinct pairs; degrees, users and
links come from these.  Links are written bucketed by ``(source, topic)`` --
``(source, topic, salt)`` when a source is hot; the state is rewritten each
round bucketed by ``(userId, topic)``, and rounds run with as many shuffle
partitions as there are buckets, so with no hot source only the
pre-aggregated offers are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from followgraph.functions.columns import interested
from followgraph.operators import lineage, skew
from followgraph.operators.graph import all_users, vertices
from followgraph.sources.schemas import INTEREST_THRESHOLD, TOPICS


def interests(topics: DataFrame, topic_cols=TOPICS, threshold: float = INTEREST_THRESHOLD) -> DataFrame:
    """``userId, topic, freq, interested`` for every row and topic."""
    long = topics.unpivot("userId", list(topic_cols), "topic", "freq")
    return long.select(
        "userId", "topic", "freq", interested(F.col("freq"), threshold).alias("interested")
    )


def initial_state(
    edges: DataFrame,
    topics: DataFrame,
    topic_cols=TOPICS,
    threshold: float = INTEREST_THRESHOLD,
    users: DataFrame | None = None,
) -> DataFrame:
    """R2: every user of the graph times every topic.  Missing frequencies
    are 0.0 (not interested); the best so far is the user's own.  Users
    that appear only in ``topics`` are left out.  ``users`` (``userId``)
    spares reading the edges for them.  Users and topics are joined one row
    each and then unpivoted."""
    users = all_users(edges) if users is None else users
    wide = users.join(topics.select("userId", *topic_cols), "userId", "left")
    long = wide.unpivot("userId", list(topic_cols), "topic", "own")
    freq = F.coalesce(F.col("own"), F.lit(0.0))
    return long.select(
        "userId",
        "topic",
        freq.alias("freq"),
        F.coalesce(interested(F.col("own"), threshold), F.lit(False)).alias("interested"),
        freq.alias("max_freq"),
        F.col("userId").alias("max_user"),
    )


@dataclass
class TopicLinks:
    links: DataFrame
    hot: DataFrame | None
    keys: tuple[str, ...]
    buckets: int
    rows: int
    tables: tuple[str, ...] = ()

    def release(self) -> None:
        for name in self.tables:
            lineage.drop_table(self.links.sparkSession, name)


@dataclass
class EdgeDegrees:
    """Distinct edges (a scratch table), their per-user degrees (checkpointed) and count."""

    dedup: DataFrame
    degrees: DataFrame
    total: int
    table: str

    def release(self) -> None:
        lineage.drop_table(self.degrees.sparkSession, self.table)


def edge_degrees(edges: DataFrame) -> EdgeDegrees:
    dedup, m, name = lineage.write_table(
        edges.select("source", "destination").distinct(), "edges", total=F.count(F.lit(1))
    )
    try:
        degrees, _ = lineage.materialize(vertices(dedup))
    except BaseException:
        lineage.drop_table(edges.sparkSession, name)
        raise
    return EdgeDegrees(dedup, degrees, int(m["total"] or 0), name)


def prepare(
    ed: EdgeDegrees,
    state: DataFrame,
    all_receivers: bool = False,
    buckets: int | None = None,
    min_rows: int = skew.HOT_MIN_ROWS,
    max_keys: int = skew.HOT_MAX_KEYS,
) -> TopicLinks:
    """Distinct edges per topic the follower is interested in (and, unless
    ``all_receivers``, the followee too), bucketed by ``(source, topic)``,
    or ``(source, topic, salt)`` when some source is hot."""
    dedup, degrees, total = ed.dedup, ed.degrees, ed.total
    buckets = buckets or lineage.bucket_count(state.sparkSession, total)
    threshold = skew.hot_threshold(total, min_rows, max_keys)
    hot_src = skew.collect_hot(degrees, "userId", "out_degree", threshold, total, max_keys)
    pairs = state.where(F.col("interested")).select("userId", "topic")

    by_source = skew.add_salt(dedup, "source", "destination", hot_src).join(
        skew.replicate(pairs.withColumnRenamed("userId", "source"), "source", hot_src),
        ["source", "salt"],
    )
    if not all_receivers:
        hot_dst = skew.collect_hot(degrees, "userId", "in_degree", threshold, total, max_keys)
        by_source = by_source.withColumnRenamed("salt", "src_salt")
        by_source = skew.add_salt(by_source, "destination", "source", hot_dst).join(
            skew.replicate(pairs.withColumnRenamed("userId", "destination"), "destination", hot_dst),
            ["destination", "topic", "salt"],
            "left_semi",
        ).select("source", "topic", F.col("src_salt").alias("salt"), "destination")
    # Bucket on the exact join keys: with no hot source the salt is the
    # constant 0, which the optimizer folds away from the join.
    keys = ("source", "topic") if hot_src is None else ("source", "topic", "salt")
    links, m, name = lineage.write_table(
        by_source.select(*keys, "destination"),
        "toplinks",
        list(keys),
        buckets,
        sort_cols=list(keys),
        rows=F.count(F.lit(1)),
    )
    return TopicLinks(links, hot_src, keys, buckets, int(m["rows"] or 0), (name,))


def numbered(state: DataFrame) -> DataFrame:
    """``state`` with ``number``: increasing in the order of ``(max_freq, max_user)``.
    Write the result before using it twice."""
    return state.orderBy("max_freq", "max_user").withColumn("number", F.monotonically_increasing_id())


def numbered_offers(senders: DataFrame, tl: TopicLinks, rows: int | None = None) -> DataFrame:
    """Per ``(userId, topic)`` receiving at least one offer, the best one:
    ``offer_freq, offer_number``.  ``rows`` bounds the senders' rows."""
    s = senders.where(F.col("interested")).select(F.col("userId").alias("source"), "topic", "max_freq", "number")
    if tl.hot is not None:
        s = skew.replicate(s, "source", tl.hot)
    if rows is not None:
        s = lineage.hash_side(s, rows, tl.buckets)
    offers = tl.links.join(s, list(tl.keys)).select(
        F.col("destination").alias("userId"), "topic", F.col("max_freq").alias("f"), F.col("number").alias("n")
    )
    return offers.groupBy("userId", "topic").agg(F.max("f").alias("offer_freq"), F.max("n").alias("offer_number"))


def best_offers(senders: DataFrame, tl: TopicLinks) -> DataFrame:
    """R3 + R4: per ``(userId, topic)`` receiving at least one offer, the
    best one: ``offer_freq, offer_user`` (higher user id wins ties)."""
    order, _ = lineage.materialize(numbered(senders))
    names = order.select(F.col("number").alias("offer_number"), F.col("max_user").alias("offer_user"))
    return numbered_offers(order, tl).join(names, "offer_number").select("userId", "topic", "offer_freq", "offer_user")


def update(state: DataFrame, best: DataFrame, rows: int | None = None, buckets: int = 1) -> DataFrame:
    """Take the offer only when strictly better; ``improved`` marks it."""
    imp = F.coalesce(F.col("offer_freq") > F.col("max_freq"), F.lit(False))
    offers = best if rows is None else lineage.hash_side(best, rows, buckets)
    return state.join(offers, ["userId", "topic"], "left").select(
        "userId",
        "topic",
        "freq",
        "interested",
        F.when(imp, F.col("offer_freq")).otherwise(F.col("max_freq")).alias("max_freq"),
        F.when(imp, F.col("offer_number")).otherwise(F.col("number")).alias("number"),
        imp.alias("improved"),
    )


def propagate(
    state: DataFrame,
    edges: DataFrame,
    iterations: int = 10,
    all_receivers: bool = False,
    buckets: int | None = None,
    min_rows: int = skew.HOT_MIN_ROWS,
    max_keys: int = skew.HOT_MAX_KEYS,
    ed: EdgeDegrees | None = None,
) -> DataFrame:
    """The state after ``iterations`` synchronous rounds.

    ``state`` is :func:`initial_state` (or its interested rows).  Returns
    ``userId, topic, freq, interested, max_freq, max_user``; free the tables
    behind it with :func:`lineage.release` when done.
    """
    if not all_receivers:
        state = state.where(F.col("interested"))
    spark = edges.sparkSession
    own_degrees = ed is None
    cols = ["userId", "topic", "freq", "interested", "max_freq"]
    order_name = name = None
    tl = None
    try:
        ed = edge_degrees(edges) if ed is None else ed
        buckets = buckets or lineage.bucket_count(spark, ed.total)
        order, m, order_name = lineage.write_table(numbered(state), "order", rows=F.count(F.lit(1)))
        rows = int(m["rows"] or 0)
        current, _, name = lineage.write_table(
            order.select(*cols, "number", F.lit(True).alias("improved")), "state", ["userId", "topic"], buckets
        )
        tl = prepare(ed, current, all_receivers, buckets, min_rows, max_keys)
        with lineage.shuffle_width(spark, buckets):
            for _ in range(iterations):
                frontier = current.where(F.col("improved"))
                best = numbered_offers(frontier, tl, rows)
                current, m, after = lineage.write_table(
                    update(current.drop("improved"), best, rows, buckets),
                    "state",
                    ["userId", "topic"],
                    buckets,
                    changed=F.count_if(F.col("improved")),
                )
                lineage.drop_table(spark, name)
                name = after
                if int(m["changed"] or 0) == 0:
                    break
    except BaseException:
        lineage.drop_table(spark, name)
        lineage.drop_table(spark, order_name)
        raise
    finally:
        if tl is not None:
            tl.release()
        if own_degrees and ed is not None:
            ed.release()
    names = order.select(F.col("number"), F.col("max_user"))
    return lineage.owned(current.select(*cols, "number").join(names, "number").select(*cols, "max_user"), name, order_name)


def pick(state: DataFrame, topic_cols=TOPICS) -> DataFrame:
    """``userId, postFrequency, topic, recommendedUserId`` for users
    with at least one interest: the highest frequency, then the lowest user
    id, then the last topic in the order of names.

    The state is dealt by user once; then three aggregations on numbers of a
    fixed width (topics by their place in the order of names), which hash and
    need no sort, settle topic, user and frequency in turn.  Each has no ties
    left for the next.
    """
    names = F.array(*[F.lit(t) for t in sorted(topic_cols)])
    cand = state.where(F.col("interested")).select(
        "userId", "max_freq", "max_user", F.array_position(names, F.col("topic")).cast("int").alias("place")
    )
    by_user = cand.repartition("userId").groupBy("userId", "max_freq", "max_user").agg(F.max("place").alias("place"))
    by_freq = by_user.groupBy("userId", "max_freq").agg(
        F.min("max_user").alias("user"), F.min_by("place", "max_user").alias("place")
    )
    best = by_freq.groupBy("userId").agg(
        F.max("max_freq").alias("postFrequency"),
        F.max_by("place", "max_freq").alias("place"),
        F.max_by("user", "max_freq").alias("recommendedUserId"),
    )
    return best.where(F.col("postFrequency") > F.lit(0.0)).select(
        "userId", "postFrequency", F.element_at(names, F.col("place")).alias("topic"), "recommendedUserId"
    )


def recommendations(
    edges: DataFrame,
    topics: DataFrame,
    iterations: int = 10,
    topic_cols=TOPICS,
    threshold: float = INTEREST_THRESHOLD,
    buckets: int | None = None,
    min_rows: int = skew.HOT_MIN_ROWS,
    max_keys: int = skew.HOT_MAX_KEYS,
) -> DataFrame:
    """One recommended user per user with an interest (self included;
    users already followed are not excluded).  Free the result's tables with
    :func:`lineage.release` when done."""
    edges = edges.select("source", "destination").where(
        F.col("source").isNotNull() & F.col("destination").isNotNull()
    )
    ed = edge_degrees(edges)
    try:
        state = initial_state(edges, topics, topic_cols, threshold, ed.degrees.select("userId"))
        final = propagate(state, edges, iterations, False, buckets, min_rows, max_keys, ed)
    finally:
        ed.release()
    return lineage.owned(pick(final, topic_cols), *getattr(final, "_fg_tables", ()))
