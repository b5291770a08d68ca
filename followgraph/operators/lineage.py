"""Lineage truncation for the iterative operators.

Each round is written to the folder the session names in
``spark.checkpoint.dir`` (a shared file system on a cluster): as a
bucketed Parquet table (:func:`write_table`) when a later join should
read it in place, else as a reliable checkpoint (:func:`materialize`).
A lost executor then costs one round, never the whole chain, and the plan
of round ``k`` does not contain rounds ``1..k-1``.  Scalars a later round
needs (rank sum, dangling mass, changed rows) are collected by
``observe`` on the same job that writes the round.

The tables are managed tables of a scratch database of the application,
which lies in that folder, so dropping a table removes its files.
Operators drop a table as soon as it is replaced, also when they fail; the
table behind a returned frame is dropped by :func:`release`, and all of
them by :func:`clear`.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; fails when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set: iterative operators checkpoint each "
        "round to a shared folder; set it on the session (spark-submit --conf "
        "spark.checkpoint.dir=hdfs:///...)"
    )


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's folder when set, otherwise ``fallback`` (tests, local runs)."""
    try:
        return checkpoint_dir(spark)
    except RuntimeError:
        spark.sparkContext.setCheckpointDir(fallback)
        return spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """Reliable eager checkpoint of ``df``; returns the truncated frame and
    the values of ``metrics`` (aggregate columns) computed by the same job.
    A checkpoint does not keep the frame's partitioning: a following join
    shuffles it."""
    checkpoint_dir(df.sparkSession)
    if not metrics:
        return df.checkpoint(eager=True), {}
    obs = Observation()
    observed = df.observe(obs, *[c.alias(k) for k, c in metrics.items()])
    out = observed.checkpoint(eager=True)
    return out, dict(obs.get)


def scratch_database(spark: SparkSession) -> str:
    """The application's scratch database, in the checkpoint folder."""
    name = "fg_scratch_" + re.sub(r"\W", "_", spark.sparkContext.applicationId)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/{name}".replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{folder}'")
    return name


def write_table(
    df: DataFrame,
    prefix: str,
    bucket_cols: list[str] | None = None,
    buckets: int = 0,
    sort_cols: list[str] | None = None,
    **metrics: Column,
) -> tuple[DataFrame, dict, str]:
    """Write ``df`` as a Parquet table of the scratch database, bucketed by
    ``bucket_cols`` if there are any, and read it back.

    Bucketing records the hash layout in the catalog, so a later join or
    aggregation on ``bucket_cols`` reads the table in place instead of
    shuffling it; that is what keeps a static edge table from moving
    every round.  Returns ``(table, metric values, table name)``.
    """
    spark = df.sparkSession
    name = f"{scratch_database(spark)}.fg_{prefix}_{uuid.uuid4().hex[:12]}"
    # One task per bucket, so one file per bucket.  When ``df`` is already
    # hash-partitioned this way (the usual case) the planner drops the
    # exchange; otherwise it keeps tasks from writing a file per bucket each.
    if bucket_cols:
        df = df.repartition(buckets, *bucket_cols)
    # Observed after the exchange: the metrics are then taken in the write's
    # result stage, whose tasks count once even when a lost executor makes
    # Spark recompute earlier stages.
    obs = Observation() if metrics else None
    if obs is not None:
        df = df.observe(obs, *[c.alias(k) for k, c in metrics.items()])
    writer = df.write
    if bucket_cols:
        writer = writer.bucketBy(buckets, *bucket_cols)
    if bucket_cols and sort_cols:
        writer = writer.sortBy(*sort_cols)
    writer.saveAsTable(name)
    return spark.table(name), (dict(obs.get) if obs is not None else {}), name


def drop_table(spark: SparkSession, name: str | None) -> None:
    """Drop a table written by :func:`write_table`, files included."""
    if name:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def owned(df: DataFrame, *names: str | None) -> DataFrame:
    """Note the tables that a returned frame reads, for :func:`release`."""
    df._fg_tables = tuple(n for n in names if n)
    return df


def release(df: DataFrame) -> None:
    """Drop the tables behind a frame that an operator returned; the frame
    cannot be read any more."""
    for name in getattr(df, "_fg_tables", ()):
        drop_table(df.sparkSession, name)


def clear(spark: SparkSession) -> None:
    """Drop every scratch table of the application."""
    spark.sql(f"DROP DATABASE IF EXISTS {scratch_database(spark)} CASCADE")


@contextmanager
def shuffle_width(spark: SparkSession, width: int) -> Iterator[None]:
    """Run the jobs inside with ``width`` shuffle partitions: joins of tables
    with that many buckets then shuffle only their other side."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(width))
    try:
        yield
    finally:
        spark.conf.set(key, before)


ROWS_PER_BUCKET = 4 << 20
MOST_BUCKETS = 100_000  # Spark's own limit (spark.sql.sources.bucketing.maxBuckets)
HASH_ROWS = 1 << 18


def bucket_count(spark: SparkSession, rows: int) -> int:
    """Buckets for a table layout of ``rows`` rows: about ``ROWS_PER_BUCKET``
    rows each, at least the cluster's parallelism, so that small data does not
    get thousands of buckets (bucketed scans are never coalesced)."""
    floor = max(1, spark.sparkContext.defaultParallelism)
    return min(MOST_BUCKETS, max(floor, -(-int(rows) // ROWS_PER_BUCKET)))


def hash_side(df: DataFrame, rows: int, buckets: int) -> DataFrame:
    """Ask for a hash join with ``df`` as build side where its ``rows`` are few
    enough for each of ``buckets`` tasks (the build side cannot spill);
    otherwise the planner's sort-merge join stays."""
    return df.hint("shuffle_hash") if rows <= buckets * HASH_ROWS else df
