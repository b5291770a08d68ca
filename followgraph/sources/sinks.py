"""Parquet sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """Overwrite ``path`` with ``df`` as Parquet, one file per partition."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def write_parquet_single(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """One output file.  Only for results of bounded size (top-N,
    statistics): every row passes through a single task."""
    df.coalesce(1).write.mode("overwrite").option("compression", compression).parquet(path)
