import hashlib
import random
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from followgraph.llm import periods, queries


def brute(words):
    """Every lag over the whole text; a stretch counts for its smallest period."""
    out = {}
    for q in range(1, len(words) // 3 + 1):
        s = 0
        while s < len(words) - q:
            e = s
            while e < len(words) - q and words[e] == words[e + q]:
                e += 1
            if e + q - s >= max(24, 3 * q):
                out.setdefault((s, e + q - s), q)
            s = max(e, s + 1) if e > s else s + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda x: (x[0], x[2]))


def runs_of(text):
    ((_, runs),) = periods.find([text.encode()])
    return runs


def test_one_word_repeated():
    assert runs_of("a " * 23) == []
    assert runs_of("a " * 24) == [(0, 24, 1)]
    assert runs_of("x y " + "a b c " * 8 + "a z") == [(2, 25, 3)]
    assert runs_of(" ".join(map(str, range(10))) + " " + "p q r s t u v w x y z " * 3) == [(10, 33, 11)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=14), st.integers(1, 12)), max_size=9))
def test_agrees_with_every_lag(pieces):
    words = [w for piece, times in pieces for w in piece * times]
    assert runs_of(" ".join(words)) == brute(words)


def test_batches_and_random_texts():
    rng = random.Random(4)
    texts = []
    for _ in range(120):
        words = []
        while len(words) < rng.randrange(0, 300):
            unit = [rng.choice("abcdefghij"[: rng.randrange(1, 10)]) for _ in range(rng.randrange(1, 40))]
            words += unit * rng.choice([1, 1, 2, 3, 4]) + unit[: rng.randrange(len(unit))]
        texts.append(" ".join(words))
    got = periods.find([t.encode() for t in texts])
    assert [r for _, r in got] == [brute(t.split()) for t in texts]
    assert sum(map(len, (r for _, r in got))) > 100


def test_small_chunks_of_lags(monkeypatch):
    words = (list("abcdefg") * 9 + list("xy") * 30 + ["q"] * 70) * 3
    whole = runs_of(" ".join(words))
    monkeypatch.setattr(periods, "BLOCKS", 50)
    assert runs_of(" ".join(words)) == whole == brute(words)


def test_long_texts_stay_fast():
    n = 200_000
    assert runs_of("a " * n) == [(0, n, 1)]
    rng = np.random.default_rng(1)
    unit = rng.integers(0, 50, n // 4).astype(str)
    words = " ".join(np.tile(unit, 4))
    assert (0, n, n // 4) in runs_of(words)


def digest(words):
    runs = brute(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    first = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(runs), *first, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def altered(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h = periods.crc(doc_id) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_given_table(spark):
    path = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, path, "documents").collect()}
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in queries.op13_periods(spark, path).collect()}
    assert got.keys() == texts.keys()
    short = {d: t for d, t in texts.items() if len(t) < 12_000}
    assert len(short) > 150
    for doc_id, text in short.items():
        assert got[doc_id] == digest(altered(doc_id, text)), doc_id
    assert sum(x[0] > 0 for x in got.values()) > 10


def test_edges(spark, tmp_path):
    ids = [i for i in range(200) if periods.crc(i) % 10 == 0][:3]
    rows = [(ids[0], None), (ids[1], ""), (ids[2], "\t \n"), (None, "a " * 30), (1, "é b " * 25), (1, "é b " * 25), (ids[0], "a b c d " * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 runs", "2 collapsed", "3 start")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_periods(spark, str(tmp_path)).collect()
    assert sorted((str(r["doc_id"]), tuple(r[c] for c in COLUMNS)) for r in got) == sorted((str(d), digest(altered(d, t))) for d, t in rows)
    empty = df.limit(0)
    empty.write.parquet(str(tmp_path / "none/documents.parquet"))
    assert queries.op13_periods(spark, str(tmp_path / "none")).collect() == []
