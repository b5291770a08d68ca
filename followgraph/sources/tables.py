"""The driver's TPC-H-like tables seen as a follower graph.

``edges``: a customer follows twice the id of every part it ordered
(``orders`` joined to ``lineitem``, every line).  ``topics``: per customer,
the number of its orders of priority 1, 2 and 3 as games, movies and music.
Customers and followed ids share one id space, so the graph has cycles;
odd ids are followed by nobody, and ids beyond the customers follow nobody.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The order priorities read as the three topics.
PRIORITY_TOPICS = (("games", "1-URGENT"), ("movies", "2-HIGH"), ("music", "3-MEDIUM"))
DESTINATION_FACTOR = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def edges_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return orders.join(items, orders.o_orderkey == items.l_orderkey).select(
        F.col("o_custkey").alias("source"), (F.col("l_partkey") * DESTINATION_FACTOR).alias("destination")
    )


def topics_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority")
    counts = [
        F.count_if(F.col("o_orderpriority") == F.lit(p)).cast("double").alias(t)
        for t, p in PRIORITY_TOPICS
    ]
    return orders.groupBy(F.col("o_custkey").alias("userId")).agg(*counts)
