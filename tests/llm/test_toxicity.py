import itertools
import math

import numpy as np
import pytest

from followgraph.llm import queries, samples, toxicity

MARKS = [f"grolm{x}" for x in ("a", "ek", "ir", "ou", "us")]


def corpus(n, seed):
    """Texts of random words; a third hold marks, whose ends vary."""
    rng = np.random.default_rng(seed)
    words = [f"{a}{b}{c}" for a in "bdfk" for b in "aeiou" for c in ("ln", "rt", "st")]
    texts, labels = [], []
    for i in range(n):
        text = list(rng.choice(words, rng.integers(5, 150)))
        labels.append(int(i % 3 == 0))
        for _ in range(labels[-1] * rng.integers(1, 4)):
            text.insert(rng.integers(len(text)), rng.choice(MARKS))
        texts.append(" ".join(text).encode())
    return texts, np.array(labels)


@pytest.fixture(scope="module")
def model():
    texts, labels = corpus(300, 1)
    return toxicity.fit(texts, labels, np.ones(len(labels)))


def brute(odds, chain):
    """Marginals, log sum and expected pairs over all taggings."""
    a = chain - chain[0, 0]
    total, marginal, pairs = 0.0, np.zeros(len(odds)), np.zeros((2, 2))
    for tags in itertools.product((0, 1), repeat=len(odds)):
        steps = list(itertools.pairwise((0, *tags)))
        weight = math.exp(sum(a[p] for p in steps) + sum(o for o, t in zip(odds, tags) if t))
        total += weight
        marginal += weight * np.array(tags)
        for p in steps:
            pairs[p] += weight
    return marginal / total, math.log(total), pairs / total


@pytest.mark.parametrize("block", [2, 3, 48])
def test_forward_backward_agrees_with_all_taggings(monkeypatch, block):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    rng = np.random.default_rng(block)
    count = np.array([3, 0, 7, 1, 9, 2])
    odds, chain = rng.normal(0, 3, count.sum()), rng.normal(0, 2, (2, 2))
    run = toxicity.Chain(odds, count, chain, pairs=True)
    parts = [brute(x, chain) for x in np.split(odds, np.cumsum(count)[:-1])]
    assert np.allclose(run.toxic, np.concatenate([p[0] for p in parts]))
    assert np.allclose(run.log_z, [p[1] for p in parts])
    assert np.allclose(run.pairs, sum(p[2] for p in parts))


def test_long_and_certain_texts_stay_finite():
    rng = np.random.default_rng(5)
    odds = rng.choice([-50.0, 50.0], 100_000)
    run = toxicity.Chain(odds, np.array([100_000]), np.array([[0, -8.0], [3.0, 8.0]]))
    assert np.isfinite(run.log_z).all() and ((run.toxic >= 0) & (run.toxic <= 1)).all()


def test_finds_marks_and_their_places(model):
    texts, labels = corpus(200, 2)
    found = toxicity.tag_texts(model, texts)
    right = np.array([(score >= queries.TOXIC_LINE) == y for (score, _), y in zip(found, labels)])
    assert right.mean() > 0.97
    hits = total = 0
    for text, (_, spans) in zip(texts, found):
        text = text.decode()
        assert all(text[s:e].split()[0].startswith("grolm") for s, e, _ in spans)
        total += text.count("grolm")
        hits += sum(text[s:e].count("grolm") for s, e, _ in spans)
    assert hits > 0.9 * total
    ((_, [(start, end, _)]),) = toxicity.tag_texts(model, ["é ü baln GROLMEK, ".encode()])
    assert (start, end) == (9, 16)


def test_same_input_same_scores_whatever_the_batch(model):
    texts, _ = corpus(60, 3)
    alone = [toxicity.tag_texts(model, [t])[0] for t in texts]
    for (a, s), (b, u) in zip(alone, toxicity.tag_texts(model, texts)):
        assert a == pytest.approx(b, abs=1e-9) and [x[:2] for x in s] == [x[:2] for x in u]


def test_edges(spark, model):
    rows = [(1, None), (1, None), (2, ""), (None, "grolma"), (3, "grolma " * 50_000), (4, "x" * 300_000), (5, "\x00퟿ .")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 score", "2 spans")
    got = df.select("doc_id", "text", toxicity.tagged(df, model).alias("found")).collect()
    assert len(got) == len(rows) and all(0 <= r["found"]["score"] <= 1 for r in got)
    assert len({r["found"]["score"] for r in got if not r["text"]}) == 1
    assert all((len(r["found"]["spans"]) > 0) == ("grolm" in (r["text"] or "")) for r in got)
    assert df.limit(0).select(toxicity.tagged(df, model)).collect() == []


def test_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, label int")
    assert toxicity.train(docs, none).constant == 0.5
    one = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (2, None)], "doc_id long, label int")
    assert toxicity.train(docs, one).constant == 1.0
    both = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int")
    assert toxicity.train(docs, both).constant == 0.5


def test_sample_is_whole_bounded_and_repeatable(spark):
    docs = spark.createDataFrame([(i, f"text {i}" * 10) for i in range(50)] + [(7, "a"), (8, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 1)], "doc_id long, label int")
    rows, sizes = samples.labelled(docs, labels, 15, 10_000)
    assert sizes == {0: 20, 1: 20} and len(rows) == 30
    assert rows == samples.labelled(docs.repartition(7), labels, 15, 10_000)[0]
    assert dict((d, t) for d, _, t in samples.labelled(docs, labels, 99, 10_000)[0])[7] == b"a"
    few, _ = samples.labelled(docs, labels, 15, 300)
    assert 0 < len(few) < 30 and all(sum(len(t) for _, y, t in few if y == c) <= 300 for c in (0, 1))


def test_held_out_rows(spark):
    path = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["toxic"] for r in queries.table(spark, path, "labels").collect()}
    held = [r for r in queries.op12_toxicity(spark, path).where("held_out").collect() if r["doc_id"] in truth]
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in held)
    caught = sum(r["predicted"] for r in held if truth[r["doc_id"]])
    assert len(held) > 900 and right > 0.97 * len(held)
    assert caught > 0.88 * sum(truth[r["doc_id"]] for r in held)
