import random

import pytest

from followgraph.operators import recommend as rc
from tests import brute
from tests.conftest import GOLDEN_EDGES, GOLDEN_TOPICS, edges_df, topics_df


def recs(spark, edges, topics, k=10, **kw):
    df = rc.recommendations(edges_df(spark, edges), topics_df(spark, topics), k, **kw)
    return {r["userId"]: (r["recommendedUserId"], r["postFrequency"], r["topic"]) for r in df.collect()}


def test_golden(spark):
    got = recs(spark, GOLDEN_EDGES, GOLDEN_TOPICS)
    assert got == {
        0: (0, pytest.approx(5.6), "movies"),
        1: (1, pytest.approx(5.3), "games"),
        2: (1, pytest.approx(5.3), "games"),
        3: (0, pytest.approx(4.2), "music"),
    }


def test_rounds_matter(spark):
    got = recs(spark, GOLDEN_EDGES, GOLDEN_TOPICS, k=1)
    assert got[3] == (3, pytest.approx(4.0), "music")
    assert got[2] == (1, pytest.approx(5.3), "games")
    got0 = recs(spark, GOLDEN_EDGES, GOLDEN_TOPICS, k=0)
    assert got0[2] == (2, pytest.approx(4.5), "games")


def test_no_interest(spark):
    assert recs(spark, [(0, 1), (1, 0)], [(0, 1.0, 2.0, 1.5), (1, 2.5, 1.8, 2.2)]) == {}


@pytest.mark.parametrize(
    "edges, topics, user, expect",
    [
        # offers: the higher user id wins among equal offers
        ([(1, 3), (2, 3)], [(1, 5, 0, 0), (2, 5, 0, 0), (3, 3, 0, 0)], 3, (2, 5.0, "games")),
        # the incumbent keeps a tie
        ([(1, 2)], [(1, 5, 0, 0), (2, 5, 0, 0)], 2, (2, 5.0, "games")),
        # final pick: the lower user id wins between topics
        ([(1, 3), (2, 3)], [(1, 5, 0, 0), (2, 0, 5, 0), (3, 3, 3, 0)], 3, (1, 5.0, "games")),
        # final pick: then the topic name descending
        ([(1, 2)], [(2, 5, 5, 5)], 2, (2, 5.0, "music")),
        # gate: user 1 holds 9 for games but is not interested, so 2 keeps its own
        ([(0, 1), (1, 2)], [(0, 9, 0, 0), (1, 0, 4, 0), (2, 3, 0, 0)], 2, (2, 3.0, "games")),
    ],
)
def test_tie_rules(spark, edges, topics, user, expect):
    got = recs(spark, edges, topics)
    assert got[user] == (expect[0], pytest.approx(expect[1]), expect[2])


def test_threshold_inclusive(spark):
    got = recs(spark, [(0, 1)], [(0, 3.0, 0, 0), (1, 2.999, 0, 0)])
    assert set(got) == {0}


def test_topic_only_user_dropped(spark):
    got = recs(spark, [(0, 1)], [(0, 4, 0, 0), (7, 9, 0, 0)])
    assert set(got) == {0}


def _random_case(rng, n_users, n_edges):
    edges = [(rng.randrange(n_users), rng.randrange(n_users)) for _ in range(n_edges)]
    topics = [
        (u, float(rng.choice([0, 1, 3, 4, 5])), float(rng.choice([0, 3, 4])), float(rng.choice([2, 3, 5])))
        for u in range(n_users)
        if rng.random() < 0.85
    ]
    return edges, topics


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_full_rounds(spark, seed):
    rng = random.Random(seed)
    edges, topics = _random_case(rng, 25, 60)
    for k in (1, 3, 10):
        assert recs(spark, edges, topics, k) == {
            u: (v[0], pytest.approx(v[1]), v[2]) for u, v in brute.recommendations(edges, topics, k).items()
        }


def test_hot_keys_do_not_change_result(spark):
    rng = random.Random(7)
    edges, topics = _random_case(rng, 20, 40)
    # user 0 follows everyone and everyone follows user 1: both keys are hot
    edges += [(0, u) for u in range(20)] + [(u, 1) for u in range(20)]
    expect = recs(spark, edges, topics, 10)
    salted = recs(spark, edges, topics, 10, min_rows=2, max_keys=1000)
    assert salted == expect
    assert expect == {u: (v[0], pytest.approx(v[1]), v[2]) for u, v in brute.recommendations(edges, topics, 10).items()}


def test_full_state_matches_brute_after_one_round(spark):
    edges, topics = GOLDEN_EDGES, GOLDEN_TOPICS
    e = edges_df(spark, edges)
    state = rc.initial_state(e, topics_df(spark, topics))
    out = rc.propagate(state, e, 1, all_receivers=True)
    rows = {(r["userId"], r["topic"]): (r["max_freq"], r["max_user"]) for r in out.collect()}
    assert len(rows) == 12
    # user 3 is not interested in games but stores the best offer it received
    assert rows[(3, "games")] == (pytest.approx(5.3), 1)


def test_empty_graph(spark):
    assert recs(spark, [], GOLDEN_TOPICS) == {}


def test_pick_like_plain_choice_by_hash_aggregation(spark):
    rnd = random.Random(5)
    rows = [(rnd.randrange(60), t, f, f >= 3.0, f, rnd.randrange(4)) for t in rc.TOPICS for f in [rnd.choice([2.0, 3.0, 4.5, 4.5, float("inf")]) for _ in range(80)]]
    rows += [(100, "games", float("nan"), True, float("nan"), 1), (100, "music", float("inf"), True, float("inf"), 0)]
    state = spark.createDataFrame(rows, "userId long, topic string, freq double, interested boolean, max_freq double, max_user long")
    chosen = {}
    for user, topic, _, ok, freq, best in rows:
        if ok:
            order = (freq != freq, 0.0 if freq != freq else freq, -best, topic)
            chosen[user] = max(chosen.get(user, order), order)
    found = rc.pick(state)
    plan = found._jdf.queryExecution().executedPlan().toString()
    got = {r["userId"]: (r["postFrequency"] != r["postFrequency"], 0.0 if r["postFrequency"] != r["postFrequency"] else r["postFrequency"], -r["recommendedUserId"], r["topic"]) for r in found.collect()}
    assert got == chosen
    assert "SortAggregate" not in plan and "HashAggregate" in plan and plan.count("Exchange hashpartitioning") == 1
