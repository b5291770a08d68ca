import pytest

from followgraph.operators import graph
from tests.conftest import GOLDEN_EDGES, edges_df


def as_map(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_stats(spark):
    st = as_map(graph.graph_stats(edges_df(spark, GOLDEN_EDGES)), "metric", "value")
    assert st == {"edge_count": 5, "vertex_count": 4}
    assert graph.edge_count(edges_df(spark, GOLDEN_EDGES)).first()["edge_count"] == 5
    users = graph.all_users(edges_df(spark, GOLDEN_EDGES))
    assert graph.vertex_count(users).first()["vertex_count"] == 4


def test_multi_edges_count(spark):
    e = edges_df(spark, [(0, 1), (0, 1), (0, 2)])
    assert as_map(graph.follower_counts(e), "userId", "followerCount") == {0: 0, 1: 2, 2: 1}
    top = graph.top_followed(e, 2).collect()
    assert [(r["userId"], r["followerCount"]) for r in top] == [(1, 2), (2, 1)]


def test_self_loop(spark):
    e = edges_df(spark, [(0, 0), (0, 1)])
    assert as_map(graph.follower_counts(e), "userId", "followerCount") == {0: 1, 1: 1}
    assert graph.dangling_users(e).collect()[0]["userId"] == 1


def test_top_n_ties_and_large_n(spark):
    e = edges_df(spark, [(5, 1), (6, 2), (7, 3), (8, 3)])
    top = graph.top_followed(e, 3).collect()
    assert [r["userId"] for r in top] == [3, 1, 2]
    assert len(graph.top_followed(e, 100).collect()) == 7


def test_dangling(spark):
    assert [r["userId"] for r in graph.dangling_users(edges_df(spark, GOLDEN_EDGES)).collect()] == [3]


def test_adjacency_keeps_repeats(spark):
    e = edges_df(spark, [(0, 1), (0, 1), (0, 2), (1, 0)])
    rows = {r["userId"]: (sorted(r["followees"]), r["outDegree"], r["part"]) for r in graph.adjacency(e).collect()}
    assert rows == {0: ([1, 1, 2], 3, 0), 1: ([0], 1, 0)}


def test_adjacency_splits_hot_lists(spark):
    pairs = [(0, u) for u in range(1, 41)] + [(0, 3), (1, 2), (2, 0)]
    rows = graph.adjacency(edges_df(spark, pairs), max_list=8).collect()
    zero = [r for r in rows if r["userId"] == 0]
    assert len(zero) > 1
    assert all(r["outDegree"] == 41 for r in zero)
    merged = sorted(x for r in zero for x in r["followees"])
    assert merged == sorted([u for u in range(1, 41)] + [3])
    assert all(len(r["followees"]) < 41 for r in zero)


def test_adjacency_with_hot_join(spark):
    pairs = [(0, u) for u in range(1, 41)] + [(1, 2), (2, 0)]
    rows = graph.adjacency(edges_df(spark, pairs), max_list=16, min_rows=4, max_keys=100).collect()
    zero = [r for r in rows if r["userId"] == 0]
    assert len(zero) == 3 and all(r["outDegree"] == 40 for r in zero)
    assert sorted(x for r in zero for x in r["followees"]) == list(range(1, 41))
    others = {r["userId"]: (r["part"], r["followees"], r["outDegree"]) for r in rows if r["userId"] != 0}
    assert others == {1: (0, [2], 1), 2: (0, [0], 1)}
