"""followgraph: follower-graph analytics on Spark DataFrames.

Edges are ``(source, destination)`` pairs meaning "source follows
destination"; topics are per-user post frequencies.  Every operator
takes and returns DataFrames and leaves physical planning to Catalyst.

Iterative operators write each round to ``spark.checkpoint.dir``, which
must be set on the session (a shared folder on a cluster).
"""

from followgraph.operators.graph import (
    adjacency,
    all_users,
    dangling_users,
    edge_count,
    follower_counts,
    graph_stats,
    top_followed,
    vertex_count,
)
from followgraph.operators.pagerank import pagerank, ranked, top_ranked
from followgraph.operators.recommend import recommendations
from followgraph.sources.sinks import write_parquet, write_parquet_single
from followgraph.sources.text import read_edges, read_topics

__all__ = [
    "adjacency",
    "all_users",
    "dangling_users",
    "edge_count",
    "follower_counts",
    "graph_stats",
    "top_followed",
    "vertex_count",
    "pagerank",
    "ranked",
    "top_ranked",
    "recommendations",
    "read_edges",
    "read_topics",
    "write_parquet",
    "write_parquet_single",
]
