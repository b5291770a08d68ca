"""The edge loader as a file stream.

New TSV files dropped into a folder are read with the same fixed schema,
reader options and cleaning as the batch loader (S1, S5).  Single-level
aggregations such as :func:`followgraph.operators.graph.follower_counts`
apply to the result unchanged (``update`` or ``complete`` output mode);
the iterative operators stay batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from followgraph.sources.schemas import EDGE_SCHEMA
from followgraph.sources.text import clean_edges, validate_path


def edge_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    schemes: tuple[str, ...] | None = None,
) -> DataFrame:
    validate_path(path, schemes)
    reader = spark.readStream.options(
        sep="\t", header="false", quote="", escape="", inferSchema="false", mode="PERMISSIVE"
    ).schema(EDGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return clean_edges(reader.csv(path))
