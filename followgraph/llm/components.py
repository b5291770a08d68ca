"""Connected components by alternating large-star and small-star.

Every pass is a grouped minimum and a join; a node with many neighbours
sends one partial minimum per task and its join partition can be split, so
no neighbourhood is gathered in one place.  Passes are written below the
shared folder and the passes before them deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from followgraph.llm import scratch


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of the undirected ``links`` of two
    different nodes: the smallest node it is connected with.  Null ends and
    links of a node with itself are ignored."""
    spark = links.sparkSession
    ends = links.select(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y")).where("x <> y")
    edges = ends.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()
    path = scratch.new(spark, "edges")
    edges.write.parquet(path)
    while True:
        edges = spark.read.schema("u long, v long").parquet(path)
        if edges.isEmpty():
            break
        # Large-star.  Every edge (u > v) lets u move on from v to v's smallest neighbour, if that is smaller.
        low = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        large = edges.join(low, F.col("v") == F.col("w"), "left")
        large = large.select("u", F.coalesce("m", "v").alias("v"), F.col("m").isNotNull().alias("moved"))
        # Small-star.  The smaller neighbours of u, and u, move to the smallest of them.
        near = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        seen = Observation()
        near = near.observe(seen, F.count_if(F.col("moved") | (F.col("v") != F.col("m"))).alias("moves"))
        small = near.select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))))
        after = scratch.new(spark, "edges")
        small.where("u <> v").distinct().write.parquet(after)
        scratch.remove(spark, path)
        path = after
        if not seen.get["moves"]:
            break
    # Nothing moved: every node but a component's smallest has one edge, to the smallest.
    edges = spark.read.schema("u long, v long").parquet(path)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
