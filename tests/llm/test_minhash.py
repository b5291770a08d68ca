"""Near-duplicate groups against a comparison of all pairs."""

import random
import re

import pytest

from followgraph.llm import components, minhash
from tests.llm import corpus


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(rows, k, threshold):
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= threshold * len(a | b):
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    return sorted(((i, len(s), None if i is None else find(i), i is None or i == find(i)) for i, s in sets), key=str)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


@pytest.mark.parametrize(("k", "threshold", "seed"), [(3, 85, 1), (5, 80, 2), (3, 85, 3)])
def test_like_all_pairs(spark, k, threshold, seed):
    texts = corpus.mixed(seed)
    assert result(minhash.near_duplicates(corpus.frame(spark, texts), k, threshold)) == brute(list(enumerate(texts)), k, threshold)


def test_star_whose_smallest_is_not_its_middle(spark):
    """Near copies of a middle that are too far from each other: links run through it only."""
    rnd = random.Random(4)
    middle = " ".join(corpus.words(rnd, 200, 10**6))
    texts = [corpus.edited(rnd, middle, 0.02) for _ in range(30)] + [middle]
    expected = brute(list(enumerate(texts)), 3, 85)
    assert result(minhash.near_duplicates(corpus.frame(spark, texts), 3, 85)) == expected
    assert sum(r[3] for r in expected) == 1


def test_tiles(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 3)
    monkeypatch.setattr(minhash, "FAN", 2)
    texts = corpus.mixed(5)
    assert result(minhash.near_duplicates(corpus.frame(spark, texts), 3, 85)) == brute(list(enumerate(texts)), 3, 85)


def test_null_and_repeated_ids(spark):
    a = " ".join(f"a{i}" for i in range(50))
    b = " ".join(f"b{i}" for i in range(50))
    rows = [(None, a), (3, a), (5, a), (5, b), (7, b), (7, b), (8, None)]
    got = result(minhash.near_duplicates(corpus.frame(spark, rows), 3, 85))
    assert got == sorted([(None, 48, None, True), (3, 48, 3, True), (5, 48, 3, False), (5, 48, 3, False), (7, 48, 3, False), (7, 48, 3, False), (8, 0, 8, True)], key=str)


def test_empty_table(spark):
    assert result(minhash.near_duplicates(corpus.frame(spark, []), 3, 85)) == []


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(200, 200)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {i: 0 for i in range(41)} | {x: 100 for x in range(100, 140)}
    assert len(got) == 81
