"""PageRank with dangling-mass redistribution.

Layout, prepared once (:func:`prepare`):

* the edges are read once and combined to ``source, destination, w`` (``w``
  = multiplicity), with repeated pairs summed before the shuffle;
* ``verts``: ``userId, out_degree`` for every user (a checkpoint whose
  job also counts users, dangling users and edges);
* ``links``: ``source, [salt,] destination, w``, bucketed by ``source`` --
  or by ``(source, salt)`` when some source is hot -- into a bucket count
  sized from the number of links;
* ``hot``: sources above the hot-key threshold with their salt counts
  (bounded, broadcast), or ``None``.

Each round is written as a table bucketed by ``userId``: ``userId,
out_degree, rank``.  The next round reads it twice in place, as senders
joined to the links and as the list of all users that the summed
contributions are joined back to.  Rounds run with as many shuffle
partitions as there are buckets, so only the pre-aggregated contributions
are shuffled, whatever the session's own setting; hot sources' senders are
copied once per salt.  Joins hash the users' side where a bucket holds few
of them and sort-merge otherwise.  The write's job also observes the rank
sum and the dangling mass for the next round.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from followgraph.functions.columns import rank_update
from followgraph.operators import lineage, skew
from followgraph.operators.graph import vertices

log = logging.getLogger(__name__)

# Rank-sum tolerances checked after every round.
RANK_SUM_WARN = 1e-10
RANK_SUM_FAIL = 1e-6


class RankSumError(ValueError):
    """The ranks of a round do not sum to 1 within ``RANK_SUM_FAIL``."""


@dataclass
class LinkGraph:
    verts: DataFrame
    links: DataFrame
    hot: DataFrame | None
    keys: tuple[str, ...]
    n: int
    n_dangling: int
    n_edges: int
    buckets: int
    tables: tuple[str, ...] = ()

    def release(self) -> None:
        spark = self.verts.sparkSession
        for name in self.tables:
            lineage.drop_table(spark, name)


def prepare(
    edges: DataFrame,
    buckets: int | None = None,
    min_rows: int = skew.HOT_MIN_ROWS,
    max_keys: int = skew.HOT_MAX_KEYS,
) -> LinkGraph:
    """Write the vertex and link tables: two jobs, each reading ``edges``
    once.  An edge source that is expensive to compute (a join, say) is
    best written out first."""
    spark = edges.sparkSession
    edges = edges.select("source", "destination").where(
        F.col("source").isNotNull() & F.col("destination").isNotNull()
    )
    made: list[str] = []
    try:
        combined = edges.groupBy("source", "destination").agg(F.count(F.lit(1)).alias("w"))
        pairs, m, pairs_name = lineage.write_table(combined, "pairs", pairs=F.count(F.lit(1)))
        made.append(pairs_name)
        verts, v = lineage.materialize(
            vertices(pairs, "w").select("userId", "out_degree"),
            n=F.count(F.lit(1)),
            dangling=F.count_if(F.col("out_degree") == 0),
            edges=F.sum("out_degree"),
        )
        n, n_dangling, n_edges = int(v["n"]), int(v["dangling"]), int(v["edges"] or 0)
        n_pairs = int(m["pairs"] or 0)
        buckets = buckets or lineage.bucket_count(spark, n_pairs)
        # Rows of the link table by source; a user has at most as many as out-edges.
        threshold = skew.hot_threshold(n_pairs, min_rows, max_keys)
        hot = skew.collect_hot(
            pairs.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "source", "n", threshold, n_pairs, max_keys
        )
        # Bucket on the exact join keys: a constant salt would be folded away
        # by the optimizer and the bucketing could no longer be used.
        keys = ("source",) if hot is None else ("source", "salt")
        salted = pairs if hot is None else skew.add_salt(pairs, "source", "destination", hot)
        links, _, name = lineage.write_table(
            salted.select(*keys, "destination", "w"), "links", list(keys), buckets, sort_cols=list(keys)
        )
        made.append(name)
    except BaseException:
        for name in made:
            lineage.drop_table(spark, name)
        raise
    lineage.drop_table(spark, pairs_name)
    return LinkGraph(verts, links, hot, keys, n, n_dangling, n_edges, buckets, (name,))


def initial_ranks(g: LinkGraph) -> DataFrame:
    """``1/N`` for every user."""
    return g.verts.select("userId", "out_degree", F.lit(1.0 / g.n).alias("rank"))


def contributions(ranks: DataFrame, g: LinkGraph) -> DataFrame:
    """P2 + P3: per receiver, the sum of ``rank * w / out_degree`` over
    its followers; users nobody follows are absent."""
    senders = ranks.where(F.col("out_degree") > 0).select(
        F.col("userId").alias("source"), (F.col("rank") / F.col("out_degree")).alias("share")
    )
    if g.hot is not None:
        senders = skew.replicate(senders, "source", g.hot)
    return (
        g.links.join(lineage.hash_side(senders, g.n, g.buckets), list(g.keys))
        .select(F.col("destination").alias("userId"), (F.col("share") * F.col("w")).alias("c"))
        .groupBy("userId")
        .agg(F.sum("c").alias("received"))
    )


def mass_held() -> Column:
    """Aggregate: the rank held by users without out-edges (0.0 if none)."""
    return F.coalesce(F.sum(F.when(F.col("out_degree") == 0, F.col("rank"))), F.lit(0.0))


def dangling_mass(ranks: DataFrame) -> DataFrame:
    """One row, :func:`mass_held`."""
    return ranks.agg(mass_held().alias("dangling_mass"))


def step(ranks: DataFrame, g: LinkGraph, mass: float, damping: float) -> DataFrame:
    """P5: one round for every user (lazy).  ``ranks`` holds every user, so
    it is also the list the received sums are joined back to."""
    received = contributions(ranks, g)
    users = ranks.select("userId", "out_degree")
    return users.join(lineage.hash_side(received, g.n, g.buckets), "userId", "left").select(
        "userId", "out_degree", rank_update(F.col("received"), mass, g.n, damping).alias("rank")
    )


def check_rank_sum(total: float, round_no: int) -> None:
    """Warn past ``RANK_SUM_WARN``, raise past ``RANK_SUM_FAIL``."""
    err = abs(float(total) - 1.0)
    if err > RANK_SUM_FAIL:
        raise RankSumError(f"round {round_no}: rank sum {total!r} is off by {err:.3e}")
    if err > RANK_SUM_WARN:
        log.warning("round %d: rank sum %r is off by %.3e", round_no, total, err)


def run(
    g: LinkGraph, iterations: int = 10, damping: float = 0.85, validate: bool = True
) -> tuple[DataFrame, list[float]]:
    """Exactly ``iterations`` rounds from ``1/N``.  Returns the last ranks
    (``userId, out_degree, rank``) and the rank sum after each round.

    Each round is written as a table bucketed by ``userId`` like ``verts``,
    so the next round's senders are already laid out like the links."""
    spark = g.verts.sparkSession
    if g.n == 0:  # no edges, no users: nothing to rank
        return g.verts.select("userId", "out_degree", F.lit(0.0).alias("rank")), []
    ranks = initial_ranks(g)
    mass = g.n_dangling / g.n
    sums: list[float] = []
    held: str | None = None
    try:
        with lineage.shuffle_width(spark, g.buckets):
            for r in range(1, iterations + 1):
                ranks, m, name = lineage.write_table(
                    step(ranks, g, mass, damping),
                    "ranks",
                    ["userId"],
                    g.buckets,
                    total=F.sum("rank"),
                    mass=mass_held(),
                )
                lineage.drop_table(spark, held)
                held = name
                sums.append(float(m["total"]))
                if validate:
                    check_rank_sum(m["total"], r)
                mass = float(m["mass"])
    except BaseException:
        lineage.drop_table(spark, held)
        raise
    return lineage.owned(ranks, held), sums


def pagerank(
    edges: DataFrame,
    iterations: int = 10,
    damping: float = 0.85,
    validate: bool = True,
    buckets: int | None = None,
    min_rows: int = skew.HOT_MIN_ROWS,
    max_keys: int = skew.HOT_MAX_KEYS,
) -> DataFrame:
    """``userId, rank`` after exactly ``iterations`` rounds (no
    convergence stop).  Unsorted; sort with :func:`ranked` when needed, and
    free the result's table with :func:`lineage.release` when done."""
    g = prepare(edges, buckets, min_rows, max_keys)
    try:
        ranks, _ = run(g, iterations, damping, validate)
    finally:
        g.release()  # the ranks read their own round table, not the links
    return lineage.owned(ranks.select("userId", "rank"), *getattr(ranks, "_fg_tables", ()))


def ranked(ranks: DataFrame) -> DataFrame:
    """Ranks by descending rank, ties by ascending ``userId``."""
    return ranks.orderBy(F.desc("rank"), F.asc("userId"))


def top_ranked(ranks: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` highest ranks, ordered here whatever the input order."""
    return ranked(ranks).limit(n)
