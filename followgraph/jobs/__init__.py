"""spark-submit entry points: network statistics, PageRank, recommendations.

Each job reads tab-separated input, writes Parquet under its output
folder and takes its checkpoint folder from ``spark.checkpoint.dir``,
falling back to ``<output>/_checkpoints`` (on the same shared storage as
the output) when the session names none.
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from followgraph.operators import lineage


def session(app: str) -> SparkSession:
    return SparkSession.builder.appName(app).getOrCreate()


def use_checkpoints(spark: SparkSession, output: str) -> str:
    return lineage.ensure_checkpoint_dir(spark, output.rstrip("/") + "/_checkpoints")


def usage(text: str, argv: list[str], minimum: int) -> None:
    if len(argv) < minimum:
        print(text, file=sys.stderr)
        raise SystemExit(1)
