"""Search against scores of every passage with every item; leaks against plain text."""

import math
import random

from followgraph.llm import decontaminate as D
from tests.llm import corpus


def items(rnd, n=40):
    out = []
    for i in range(n):
        lines = [" ".join(corpus.words(rnd, rnd.choice([1, 4, 10, 30]), 80)) for _ in range(rnd.choice([1, 2, 3]))]
        out.append((i, ".\n".join(lines) + "."))
    return out


def test_wand_and_screen_like_all_scores(monkeypatch):
    rnd = random.Random(1)
    monkeypatch.setattr(D, "BLOCK", 3)
    index = D.Index(items(rnd, 120))
    for group in index.classes:
        full = {}
        for term, (number, impact, *_) in group.lists.items():
            for n, x in zip(number, impact, strict=True):
                full.setdefault(n, {})[term] = x
        assert all(abs(sum(x.values()) - 1) < 1e-9 for x in full.values())
        for _ in range(200):
            n = rnd.randrange(len(full))
            words = rnd.sample(sorted(full[n]), max(1, int(len(full[n]) * rnd.choice([0.3, 0.6, 0.9])))) + rnd.sample(sorted(group.lists), min(5, len(group.lists)))
            scores = {m: math.fsum(x for t, x in full[m].items() if t in set(words)) for m in full}
            expected = sorted(m for m, s in scores.items() if s >= group.threshold - 1e-9)
            assert sorted(m for m, _ in group.query(words)) == expected
            array = D.np.array(words[: 2 * group.longest], dtype=D.np.uint64)
            if any(math.fsum(x for t, x in full[m].items() if t in set(array.tolist())) >= group.threshold for m in full):
                assert group.screen(array, D.np.array([0, len(array)]))


def brute(text, question, answer):
    hashes, first = D.term_hashes([text, question, answer])
    whole, q, a = (hashes[first[i] : first[i + 1]].tolist() for i in range(3))
    return min(D.overlap(q, whole), D.overlap(a, whole)) >= D.OVERLAP and len(q) > 0


def test_leaks_in_documents(spark):
    rnd = random.Random(2)
    bench = [(i, " ".join(corpus.words(rnd, n, 10**6)) + ".\n" + " ".join(corpus.words(rnd, 7, 10**6))) for i, n in enumerate([10, 25, 40, 90])]
    texts = []
    for i in range(60):
        before, after = (" ".join(corpus.words(rnd, rnd.randrange(300), 10**5)) for _ in range(2))
        item = bench[i % 4][1]
        middle = {0: item, 1: item.upper().replace("\n", " "), 2: item.split("\n")[0], 3: corpus.edited(rnd, item.replace("\n", " "), 0.02)}[i // 4 % 4]
        texts.append(f"{before} {middle} {after}")
    texts += [None, "", bench[0][1], " ".join(corpus.words(rnd, 3000, 10**5))]
    table = spark.createDataFrame([*bench, (None, "x"), (9, None), (10, "")], "item_id long, text string")
    docs = corpus.frame(spark, texts).withColumn("found", D.leaks(table))
    got = {(r["doc_id"], x["item_id"]) for r in docs.collect() for x in r["found"]}
    parts = {i: D.question_answer(t) for i, t in bench}
    expected = {(d, i) for d, t in enumerate(texts) for i, (q, a) in parts.items() if brute(t or "", q, a)}
    assert got == expected and len(expected) > 30
    assert docs.where("doc_id < 0").collect() == []
    assert corpus.frame(spark, texts[:2]).withColumn("found", D.leaks(table.where("false"))).where("size(found) > 0").count() == 0


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(D, "SHARD_WORDS", 30)
    rnd = random.Random(3)
    bench = [(i, " ".join(corpus.words(rnd, 20, 10**6))) for i in range(5)]
    table = spark.createDataFrame(bench, "item_id long, text string")
    assert len(list(D.shards(table))) == 5
    docs = corpus.frame(spark, [t for _, t in bench]).withColumn("found", D.leaks(table))
    assert {(r["doc_id"], *(x["item_id"] for x in r["found"])) for r in docs.collect()} == {(i, i) for i in range(5)}


def test_items_without_id_are_found(spark):
    rnd = random.Random(7)
    items = [" ".join(corpus.words(rnd, 20, 10**6)) for _ in range(3)]
    table = spark.createDataFrame([(None, items[0]), (None, items[1]), (0, items[2])], "item_id long, text string")
    texts = [items[0], " ".join(items), "clean", items[2]]
    docs = corpus.frame(spark, texts).withColumn("found", D.leaks(table))
    assert {r["doc_id"]: [x["item_id"] for x in r["found"]] for r in docs.collect()} == {0: [None], 1: [None, None, 0], 2: [], 3: [0]}


def test_scores_do_not_depend_on_shards(spark, monkeypatch):
    rnd = random.Random(8)
    bench = [(i, " ".join(corpus.words(rnd, rnd.choice([8, 15, 40, 100]), 60))) for i in range(12)] + [(None, "a b c d e f"), (3, "...")]
    bench += [bench[2], (77, bench[5][1])]
    table = spark.createDataFrame(bench, "item_id long, text string")
    texts = [t + " " + corpus.edited(rnd, u, 0.02) for (_, t), (_, u) in zip(bench, bench[3:], strict=False)]
    found = []
    for size in (10, 120, 1_000_000):
        monkeypatch.setattr(D, "SHARD_WORDS", size)
        rows = corpus.frame(spark, texts).withColumn("found", D.leaks(table)).collect()
        found.append({r["doc_id"]: sorted(map(str, r["found"])) for r in rows})
    assert found[0] == found[1] == found[2] and sum(map(len, found[0].values())) > 15
    # The statistics are those of an index of all items at once.
    (items, of_all), *rest = D.shards(table)
    plain = D.Index([(i, t) for i, t in items])
    given = D.Index(items, of_all=of_all)
    assert not rest and [c.lists for c in plain.classes] == [c.lists for c in given.classes]
