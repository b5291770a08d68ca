"""Base counts by brute force; the model sums to one; bands by language."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from followgraph.llm import perplexity as P
from tests.llm import corpus

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    w, windows, covered = re.findall(WORD, text), {}, set()
    for i in range(len(w) - 4):
        windows.setdefault(tuple(w[i : i + 5]), []).append(i)
    for places in windows.values():
        if len(places) > 1:
            covered.update(x for i in places for x in range(i, i + 5))
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            repeated += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered)


def texts(seed, n=60):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        w = [rnd.choice(["a", "bé", "c#", "d|", "\n", "e\te", "日"]) for _ in range(rnd.randrange(60))]
        out.append(" ".join(w) + rnd.choice(["", "\n", " " * 3]))
    return [*out, "", None, "x " * 50, "same line\nsame line\n\n\nsame line"]


def test_base_counts():
    some = texts(1)
    got = P.base_counts([(t or "").encode() for t in some])
    assert list(zip(*(got[c].tolist() for c in P.COUNTS), strict=True)) == [brute(t) for t in some]


def test_probabilities_sum_to_one():
    code, n = np.unique(P.codes([t.encode() for t in texts(2) if t])[0], return_counts=True)
    model = P.KneserNey(code, n)
    contexts = [*np.unique(code >> 5)[:50].tolist(), 0, 12345]
    for c in contexts:
        assert abs(model.probability((c << 5) + np.arange(32)).sum() - 1) < 1e-9


def test_counts_of_all_texts_and_rules(spark):
    rnd = random.Random(3)
    clean = [" ".join(corpus.words(rnd, rnd.randrange(20, 200), 300)) for _ in range(80)]
    odd = ["#!%" * 60 + " " + " ".join("#$%^" * 4 for _ in range(20)), None, "", "a b c"]
    docs = corpus.frame(spark, clean + odd)
    counted = {r["code"]: r["n"] for r in P.counted(docs).collect()}
    code, n = np.unique(P.codes([(t or "").encode() for t in clean + odd])[0], return_counts=True)
    assert counted == dict(zip(code.tolist(), n.tolist(), strict=True))
    got = {r["doc_id"]: r for r in P.rules(docs).collect()}
    assert [tuple(got[i][c] for c in P.COUNTS) for i in range(84)] == [brute(t) for t in clean + odd]
    assert all(got[i]["kept"] for i in range(80)) and not got[80]["kept"]
    assert got[81]["base_failed"] and got[82]["base_failed"] and got[82]["surprise"] is None
    assert P.rules(docs.where("false")).collect() == []


def without_one(texts, run):
    """Probability of the last byte of ``run`` after the others, one occurrence of it less, by brute force."""
    pad = b"\n" * (P.BYTES - 1)
    full = {}
    for t in texts:
        for i in range(len(t)):
            g = (pad + t)[i : i + P.BYTES]
            full[g] = full.get(g, 0) + 1

    def below(level):
        out = {}
        for g in level:
            out[g[1:]] = out.get(g[1:], 0) + 1
        return out

    def orders(level):
        out = [level]
        while len(next(iter(out[-1]))) > P.LOWEST:
            out.append(below(out[-1]))
        return out

    cuts = [P.discounts([sum(n == c for n in x.values()) for c in (1, 2, 3, 4)]) for x in orders(full)]
    fewer = {g: n - (g == run) for g, n in full.items() if n > (g == run)}
    symbols, n = np.unique(P.codes(texts)[0], return_counts=True)
    seen = np.ones(256)
    for b in b"".join(texts):
        seen[b] += 1
    share = seen / np.bincount(P.ALPHABET, seen, 32)[P.ALPHABET]
    code = np.array([int.from_bytes(run[-P.LOWEST :], "big")])
    p = P.class_base(P.KneserNey(symbols, n), share, code)[0]
    for level, cut in reversed(list(zip(orders(fewer), cuts, strict=True))):
        g = run[-len(next(iter(level))) :]
        near = [n for x, n in level.items() if x[:-1] == g[:-1]]
        if near:
            take = lambda n: cut[min(n, 3) - 1] if n else 0.0  # noqa: B023, E731
            own = level.get(g, 0)
            p = (own - take(own)) / sum(near) + sum(map(take, near)) / sum(near) * p
    return p


def test_byte_model_against_brute_force(spark):
    some = [t.encode() for t in texts(5, 12) if t]
    rows = corpus.frame(spark, [t.decode() for t in some])
    got = {r["code"]: r["surprise"] / P.GRAIN for r in P.surprises(P.byte_counts(rows), P.model(rows)).collect()}
    codes = np.unique(P.byte_codes(some)[0]).tolist()
    assert sorted(got) == codes
    for code in codes[:: max(1, len(codes) // 60)]:
        assert abs(got[code] + np.log(without_one(some, code.to_bytes(P.BYTES, "big")))) < 1 / P.GRAIN
    judged = P.rules(rows).where(F.col("surprise").isNotNull()).collect()
    for r in judged:
        mine = P.byte_codes([some[r["doc_id"]]])[0].tolist()
        assert abs(r["surprise"] - sum(got[c] for c in mine) / len(mine)) < 1e-4


def test_letters_beyond_ascii_and_word_order_count(spark):
    """Noise with the letters, lengths and spaces of the prose, and words in
    another order, score unlike it."""
    rnd = random.Random(4)
    letters = "абвгдежзиклмнопрстуфхцчшы"
    vocabulary = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(3, 9))) for _ in range(60)]
    phrase = {w: rnd.sample(vocabulary, 2) for w in vocabulary}

    def prose():
        w = [rnd.choice(vocabulary)]
        while len(w) < 80:
            w.append(rnd.choice(phrase[w[-1]]))
        return w

    some = [prose() for _ in range(60)]
    noise = ["".join(rnd.choice(letters) for _ in w) for w in some[0]]
    shuffled = rnd.sample(some[1], 80)
    got = {r["doc_id"]: r for r in P.rules(corpus.frame(spark, [" ".join(w) for w in [*some, noise, shuffled]])).collect()}
    usual = [got[i]["surprise"] for i in range(60)]
    assert got[60]["surprise"] > 2 * max(usual) and not got[60]["kept"]
    assert got[61]["surprise"] > 1.05 * got[1]["surprise"]


def test_means_and_sorted_codes():
    some = [(t or "").encode() for t in texts(6)] * 3
    code = P.distinct(np.concatenate([P.byte_codes([t])[0] for t in some]))
    assert code.tolist() == np.unique(P.byte_codes(some)[0]).tolist() and P.distinct(code[:0]).tolist() == []
    value = np.random.default_rng(1).random(len(code))
    got = P.means(some, code, value)
    for text, mean in zip(some, got, strict=True):
        mine = P.byte_codes([text])[0]
        assert (mean is None) == (not len(mine)) and (mean is None or abs(mean - value[np.searchsorted(code, mine)].mean()) < 1e-12)
    both, n = P.merged([(np.array([1, 5]), np.array([2, 3])), (np.array([5, 9]), np.array([4, 1])), (code[:0], code[:0])])
    assert both.tolist() == [1, 5, 9] and n.tolist() == [2, 7, 1]
