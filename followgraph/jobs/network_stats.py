"""Graph statistics and the most followed users.

    spark-submit followgraph/jobs/network_stats.py <input> <output> [topN=100]

Writes ``<output>/graph-stats`` (metric, value) and
``<output>/top-<N>-users`` (userId, followerCount).  One aggregation over
the edges gives both: edge count = sum of out-degrees, vertex count =
rows, follower count = in-degree.
"""

from __future__ import annotations

import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit: make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from followgraph.jobs import session, usage, use_checkpoints
from followgraph.operators import lineage
from followgraph.operators.graph import vertices
from followgraph.sources import sinks, text

USAGE = "usage: network_stats.py <input> <output> [topN=100]"


def run(spark: SparkSession, argv: list[str]) -> None:
    usage(USAGE, argv, 2)
    src, out = argv[0], argv[1].rstrip("/")
    top_n = int(argv[2]) if len(argv) > 2 else 100
    use_checkpoints(spark, out)
    edges = text.read_edges(spark, src)
    verts, m = lineage.materialize(vertices(edges), n=F.count(F.lit(1)), e=F.sum("out_degree"))
    print(f"edges: {m['e'] or 0}, users: {m['n']}")
    stats = spark.createDataFrame(
        [("edge_count", int(m["e"] or 0)), ("vertex_count", int(m["n"]))], "metric string, value long"
    )
    sinks.write_parquet_single(stats, f"{out}/graph-stats")
    top = (
        verts.select("userId", F.col("in_degree").alias("followerCount"))
        .orderBy(F.desc("followerCount"), F.asc("userId"))
        .limit(top_n)
    )
    top, _ = lineage.materialize(top)
    sinks.write_parquet_single(top, f"{out}/top-{top_n}-users")
    top.show(min(top_n, 20), truncate=False)


def main() -> None:
    run(session("network-stats"), sys.argv[1:])


if __name__ == "__main__":
    main()
