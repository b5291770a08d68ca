import random

import pytest

from followgraph.operators import pagerank as pr
from tests import brute
from tests.conftest import GOLDEN_EDGES, edges_df

# Expected ranks of the 4-user golden graph, k = 10, d = 0.85.
GOLDEN_RANKS = {0: 0.16126908461, 1: 0.12564836379, 2: 0.29835420937, 3: 0.41472834221}
K1_RANKS = {0: 0.16145833333, 1: 0.090625, 2: 0.37395833333, 3: 0.37395833333}


def ranks_of(df):
    return {r["userId"]: r["rank"] for r in df.collect()}


def test_golden_ranks(spark):
    got = ranks_of(pr.pagerank(edges_df(spark, GOLDEN_EDGES), 10, 0.85))
    assert set(got) == set(GOLDEN_RANKS)
    assert abs(sum(got.values()) - 1.0) < 1e-10
    for u, r in GOLDEN_RANKS.items():
        assert got[u] == pytest.approx(r, abs=1e-6)


def test_one_round_and_zero_rounds(spark):
    got = ranks_of(pr.pagerank(edges_df(spark, GOLDEN_EDGES), 1, 0.85))
    for u, r in K1_RANKS.items():
        assert got[u] == pytest.approx(r, abs=1e-9)
    assert ranks_of(pr.pagerank(edges_df(spark, GOLDEN_EDGES), 0)) == {u: 0.25 for u in range(4)}
    ten = ranks_of(pr.pagerank(edges_df(spark, GOLDEN_EDGES), 10))
    assert any(abs(ten[u] - got[u]) > 1e-6 for u in ten)


def test_no_dangling(spark):
    got = ranks_of(pr.pagerank(edges_df(spark, [(0, 2), (1, 0), (1, 2), (2, 1)])))
    assert sum(got.values()) == pytest.approx(1.0, abs=1e-10)
    assert all(r > 0 for r in got.values())


def test_two_cycle(spark):
    got = ranks_of(pr.pagerank(edges_df(spark, [(0, 1), (1, 0)])))
    assert got == {0: pytest.approx(0.5), 1: pytest.approx(0.5)}


def test_multi_edge_weight(spark):
    edges = [(0, 1), (0, 1), (0, 2)]
    got = ranks_of(pr.pagerank(edges_df(spark, edges), 1))
    exp = brute.pagerank(edges, 1)
    for u in exp:
        assert got[u] == pytest.approx(exp[u], abs=1e-12)
    # user 1 receives 2/3 of user 0's rank, user 2 one third
    base = (1 - 0.85) / 3 + 0.85 * (2 / 3) / 3
    assert got[1] - base == pytest.approx(0.85 * (1 / 3) * (2 / 3), abs=1e-12)


def test_all_dangling_but_one(spark):
    got = ranks_of(pr.pagerank(edges_df(spark, [(0, 1), (0, 2)])))
    assert sum(got.values()) == pytest.approx(1.0, abs=1e-10)


@pytest.mark.parametrize("seed", [11, 12])
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(30), rng.randrange(30)) for _ in range(80)]
    got = ranks_of(pr.pagerank(edges_df(spark, edges), 10))
    exp = brute.pagerank(edges, 10)
    assert set(got) == set(exp)
    for u in exp:
        assert got[u] == pytest.approx(exp[u], abs=1e-12)


def test_hot_sources_are_split(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(30), rng.randrange(30)) for _ in range(60)]
    edges += [(0, u) for u in range(30)] * 2 + [(u, 1) for u in range(30)]
    g = pr.prepare(edges_df(spark, edges), min_rows=4, max_keys=1000)
    assert g.hot is not None and g.hot.count() >= 1
    assert g.links.where("salt > 0").count() > 0
    ranks, sums = pr.run(g, 10)
    got = {r["userId"]: r["rank"] for r in ranks.collect()}
    exp = brute.pagerank(edges, 10)
    for u in exp:
        assert got[u] == pytest.approx(exp[u], abs=1e-12)
    assert len(sums) == 10 and all(abs(s - 1) < 1e-10 for s in sums)


def test_rank_sum_check():
    pr.check_rank_sum(1.0 + 1e-12, 1)
    pr.check_rank_sum(1.0 + 1e-8, 1)  # warns only
    with pytest.raises(pr.RankSumError):
        pr.check_rank_sum(1.01, 3)


def test_top_ranked_orders_itself(spark):
    ranks = pr.pagerank(edges_df(spark, GOLDEN_EDGES))
    top = pr.top_ranked(ranks.orderBy("rank"), 2).collect()
    assert [r["userId"] for r in top] == [3, 2]
    assert len(pr.top_ranked(ranks, 100).collect()) == 4


def test_corrupted_ranks_raise(spark):
    g = pr.prepare(edges_df(spark, GOLDEN_EDGES))
    g.n += 3  # ranks now start at 1/7 for 4 users: the sum is off
    with pytest.raises(pr.RankSumError):
        pr.run(g, 2)


def test_self_loop_rank(spark):
    edges = [(0, 0), (0, 1), (1, 2)]
    got = ranks_of(pr.pagerank(edges_df(spark, edges), 10))
    exp = brute.pagerank(edges, 10)
    for u in exp:
        assert got[u] == pytest.approx(exp[u], abs=1e-12)


def test_third_of_edges_in_one_source_is_spread(spark):
    from pyspark.sql import functions as F

    rng = random.Random(9)
    # 200 ordinary edges plus 100 edges out of user 0: a third of the table
    edges = [(rng.randrange(1, 60), rng.randrange(60)) for _ in range(200)]
    edges += [(0, u) for u in range(100)]
    g = pr.prepare(edges_df(spark, edges), min_rows=16, max_keys=1000)
    hot = {r["hot_key"]: r["n_salt"] for r in g.hot.collect()}
    assert hot[0] >= 2
    groups = g.links.where("source = 0").groupBy("salt").agg(F.count("*").alias("n")).collect()
    assert len(groups) > 1 and max(r["n"] for r in groups) < 100
    ranks, _ = pr.run(g, 10)
    got = {r["userId"]: r["rank"] for r in ranks.collect()}
    exp = brute.pagerank(edges, 10)
    assert set(got) == set(exp)
    for u in exp:
        assert got[u] == pytest.approx(exp[u], abs=1e-12)


def test_empty_graph(spark):
    assert pr.pagerank(edges_df(spark, []), 10).collect() == []
