"""Tab-separated edge and topic loaders.

The reader never infers: it is given the fixed schema, quoting and
escaping are off, and every line that fails to parse becomes a null
that the cleaning filters drop.  Bad lines therefore never fail a job.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from followgraph.sources.schemas import EDGE_SCHEMA, TOPIC_SCHEMA, TOPICS

_MB = 1024 * 1024


def validate_path(path: str, schemes: tuple[str, ...] | None = None) -> None:
    """Reject a path whose scheme is not allowed.

    ``schemes=None`` accepts every path (local, ``file:``, ``hdfs:``...);
    pass e.g. ``("s3://", "s3a://", "s3n://")`` to insist on object storage.
    """
    if not path or not path.strip():
        raise ValueError("input path is empty")
    if schemes is not None and not path.startswith(tuple(schemes)):
        raise ValueError(f"path {path!r} must start with one of {', '.join(schemes)}")


def read_tsv(spark: SparkSession, path: str, schema, header: bool = False) -> DataFrame:
    """Scan tab-separated text with a fixed schema, no quoting, no escaping."""
    return (
        spark.read.options(
            sep="\t",
            header=str(header).lower(),
            multiLine="false",
            quote="",
            escape="",
            inferSchema="false",
            mode="PERMISSIVE",
        )
        .schema(schema)
        .csv(path)
    )


def plan_partitions(size_bytes: int | None, parallelism: int) -> int:
    """Partition count for a scan of ``size_bytes``.

    One partition per 128 MB, at least ``2 * parallelism`` and at most
    ``20 * parallelism``; ``4 * parallelism`` when the size is unknown.
    """
    if size_bytes is None or size_bytes < 0:
        return 4 * parallelism
    by_size = (size_bytes // _MB) // 128
    return int(min(max(by_size, 2 * parallelism), 20 * parallelism))


def input_size(spark: SparkSession, path: str) -> int | None:
    """Total bytes under ``path``, listed by Spark (file contents are not read)."""
    try:
        row = (
            spark.read.format("binaryFile")
            .load(path)
            .agg(F.sum("length").alias("bytes"))
            .first()
        )
    except AnalysisException:  # no such path: the reader itself will say so
        return None
    return None if row is None or row["bytes"] is None else int(row["bytes"])


def _key_long(c: str) -> Column:
    return F.expr(f"try_cast(`{c}` AS BIGINT)")


def clean_edges(df: DataFrame) -> DataFrame:
    """Both ends as bigint, rows with a null end dropped.

    Multi-edges and self-loops are kept; they count everywhere.
    """
    return df.select(
        _key_long("source").alias("source"),
        _key_long("destination").alias("destination"),
    ).where(F.col("source").isNotNull() & F.col("destination").isNotNull())


def clean_topics(df: DataFrame, topics=TOPICS) -> DataFrame:
    """Id as bigint, frequencies as double; drop rows with a null id or
    any null or negative frequency.  NaN and +Inf pass (Spark orders NaN
    above every number), as does -0.0."""
    freqs = [F.expr(f"try_cast(`{t}` AS DOUBLE)").alias(t) for t in topics]
    out = df.select(_key_long("userId").alias("userId"), *freqs)
    keep = F.col("userId").isNotNull()
    for t in topics:
        keep = keep & F.col(t).isNotNull() & (F.col(t) >= F.lit(0.0))
    return out.where(keep)


def read_edges(
    spark: SparkSession,
    path: str,
    header: bool = False,
    partitions: int | str | None = None,
    schemes: tuple[str, ...] | None = None,
) -> DataFrame:
    """Load and clean an edge list.

    ``partitions=None`` keeps the scan's own splits (sized by
    ``spark.sql.files.maxPartitionBytes``); ``"auto"`` deals the rows evenly
    into :func:`plan_partitions` of the input size; an int uses that count.
    """
    validate_path(path, schemes)
    edges = clean_edges(read_tsv(spark, path, EDGE_SCHEMA, header))
    if partitions is None:
        return edges
    if partitions == "auto":
        par = spark.sparkContext.defaultParallelism
        partitions = plan_partitions(input_size(spark, path), par)
    return edges.repartition(int(partitions))


def read_topics(
    spark: SparkSession,
    path: str,
    header: bool = False,
    topics=TOPICS,
    schemes: tuple[str, ...] | None = None,
) -> DataFrame:
    """S3: load and clean the topic table.  A header line read with
    ``header=False`` fails to parse and is dropped like any bad line."""
    from followgraph.sources.schemas import topic_schema

    validate_path(path, schemes)
    schema = TOPIC_SCHEMA if tuple(topics) == TOPICS else topic_schema(topics)
    return clean_topics(read_tsv(spark, path, schema, header), topics)
