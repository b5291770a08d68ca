"""Targets and the dual solution against plain computations; copies; odd rows."""

import math
import random

from followgraph.llm import mixing
from tests.llm import corpus


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "x") for i, t, s in rows], "doc_id long, text string, source string, target string")


def some(seed, sources, n=400):
    rnd = random.Random(seed)
    return [(i, " ".join(["w"] * int(rnd.lognormvariate(3, 1))), rnd.choice(sources)) for i in range(n)]


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    out, free, rest = {}, set(names), float(sum(sizes.values()))
    while free:
        share = rest / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * share > 3 * sizes[s]}
        if not over:
            return out | {s: weight[s] * share for s in free}
        out |= {s: 3.0 * sizes[s] for s in over}
        rest -= sum(3.0 * sizes[s] for s in over)
        free -= over
    return out


def check(spark, rows):
    got = mixing.mixed(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    targets = plain_targets(sizes)
    for s in sizes:
        own = [r for r in got if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and abs(r["target"] - targets[s]) < 1e-6 * max(1, targets[s]) for r in own)
        open_ = sum(r["taken"] for r in own) - targets[s]
        can = [r["size"] for r in own if r["size"] and (r["copies"] < 3 if open_ < 0 else r["copies"] > 0)]
        assert not can or abs(open_) <= 0.5 * min(can) + 0.5
    assert all(0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"] for r in got)
    return got


def test_targets_copies_and_reruns(spark):
    rows = some(1, ["a", "b", "é", "Z"]) + [(1000 + i, "v " * 50, "a") for i in range(300)]
    rows += [(2000, None, "b"), (2001, "", None), (2002, "one two", None), (None, "a b c", "a"), (3, "a b", "b")]
    first = check(spark, rows)
    again = mixing.mixed(docs(spark, rows).repartition(5)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_full_sources(spark):
    rows = some(2, ["b"], 300) + [(1000 + i, "w w", "c") for i in range(10)] + [(2000 + i, "w w w", "a") for i in range(5)]
    got = check(spark, rows)
    assert all(r["copies"] == 3 for r in got if r["source"] == "c")


def test_few_large_documents_and_copies_of_one_size(spark):
    rows = [(i, "w " * n, "a") for i, n in enumerate([9000, 4000, 700, 650, 90, 33, 20, 20, 7, 2, 1])]
    rows += [(100 + i, "w " * 13, "b") for i in range(300)] + [(None, "w " * 13, "b")] * 40
    rows += [(500 + i, "w " * (1 + i % 9), None) for i in range(2000)]
    got = check(spark, rows)
    again = mixing.mixed(docs(spark, rows[::-1]).repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_rates_are_the_dual_solution(spark):
    rows = some(3, ["a", "b"])
    sizes = mixing.targets
    table = docs(spark, rows).select("source", mixing.words("text").alias("size"))
    goal = sizes(table)
    dual = {r["source"]: r for r in mixing.multipliers(table, goal).collect()}
    want = {r["source"]: r["target"] for r in goal.collect()}
    for s, r in dual.items():
        own = [len(t.split()) for _, t, x in rows if x == s]
        taken = sum(n * min(3.0, math.exp(min(5, r["x"] * n / r["mean"]))) for n in own)
        assert abs(taken - want[s]) < 1e-6 * want[s]


def test_empty_table_and_no_words(spark):
    assert mixing.mixed(docs(spark, [])).collect() == []
    got = mixing.mixed(docs(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in got] == [(0, 0, 0.0)] * 2
    assert corpus.SCHEMA
