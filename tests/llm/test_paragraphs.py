"""Repeated paragraphs: near copies of lines, and passages inside other lines."""

import random

from followgraph.llm import paragraphs
from tests.llm import corpus


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_passages_lines_and_clean_texts(spark):
    rnd = random.Random(1)
    fresh = lambda n: " ".join(corpus.words(rnd, n, 10**7))
    passage, line = fresh(55), fresh(60)
    near = corpus.edited(rnd, line, 0.02)
    texts = [
        f"{fresh(30)} {passage} {fresh(20)}",
        f"{fresh(3)}\n{fresh(40)} {passage.upper()} {fresh(33)}",
        f"{fresh(10)}\n{line}\n{fresh(12)}",
        f"{near}\n{fresh(50)}",
        fresh(200),
        f"{passage}\n{passage}",
        None,
        "",
        "few words",
    ]
    got = rows(paragraphs.kept(corpus.frame(spark, texts)))
    assert {i: r["owners"] for i, r in got.items() if r["owners"]} == {1: [0], 3: [2], 5: [0]}
    assert sorted(i for i, r in got.items() if r["n_shared"]) == [0, 1, 2, 3, 5]
    for i, text in enumerate(texts):
        data = (text or "").encode()
        spans = [(s["start"], s["end"]) for s in got[i]["spans"]]
        assert spans == sorted(spans) and all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
        left = b"".join(data[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(data)], strict=True))
        assert bytes(got[i]["kept"]) == left
    assert bytes(got[3]["kept"]).decode() == texts[3][len(near) :]


def test_every_shared_passage_is_found(spark):
    """Passages of 50 words at any place of any line are met again."""
    rnd = random.Random(2)
    texts, expected = [], {}
    for i in range(40):
        passage = " ".join(corpus.words(rnd, 50, 10**7))
        for _ in range(2):
            before, after = (" ".join(corpus.words(rnd, rnd.randrange(90), 10**7)) for _ in range(2))
            texts.append(f"{before} {passage} {after}")
        expected[2 * i + 1] = [2 * i]
    got = rows(paragraphs.kept(corpus.frame(spark, texts)))
    assert {i: r["owners"] for i, r in got.items() if r["owners"]} == expected


def test_null_and_repeated_ids_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(60))
    got = paragraphs.kept(corpus.frame(spark, [(None, text), (None, text), (4, text), (4, text), (7, "x")])).collect()
    assert sorted(((r["doc_id"], len(r["kept"]) == 0, r["owners"]) for r in got), key=str) == sorted([(4, False, []), (4, False, []), (7, False, []), (None, True, [4]), (None, True, [4])], key=str)
    assert paragraphs.kept(corpus.frame(spark, [])).collect() == []


def test_the_whole_passage_goes(spark):
    """Of passages of 50 words and more inside other lines, nothing stays in
    the larger id, and nothing else goes."""
    rnd = random.Random(6)
    texts, left = [], {}
    for n in [50, 51, 55, 60, 80, 120, 300] * 4:
        passage = corpus.words(rnd, n, 10**7)
        for again in (False, True):
            before, after = (corpus.words(rnd, rnd.randrange(1, 90), 10**7) for _ in range(2))
            if again:
                left[len(texts)] = before + after
            between = [rnd.choice([" ", "\n", "  "]) for _ in passage]
            texts.append(" ".join(before) + " " + "".join((w.upper() if again else w) + s for w, s in zip(passage, between, strict=True)) + " ".join(after))
    got = rows(paragraphs.kept(corpus.frame(spark, texts)))
    for i, text in enumerate(texts):
        assert bytes(got[i]["kept"]).decode().split() == left.get(i, text.split())


def test_agreement_is_verified():
    own = [b"w%d" % i for i in range(40)]
    g = paragraphs.GRAM
    window = own[5 : 5 + g]
    assert paragraphs.agreement(own, 5, 5 + g, [b"x", *own[3:5], *window], [own[5 + g], b"y"]) == (3, 6 + g)
    assert paragraphs.agreement(own, 5, 5 + g, [*own[:5], *window], [*own[5 + g :], b"y"]) == (0, 40)
    assert paragraphs.agreement(own, 5, 5 + g, [*window[:-1], b"x"], []) is None


def units_of(text):
    found = paragraphs.Paragraphs([text.encode()])
    n = len(found.sig)
    return list(zip(found.first[:n].tolist(), found.last[:n].tolist(), strict=True))


def test_chunks_depend_on_the_content_alone():
    rnd = random.Random(8)
    for _ in range(30):
        middle = corpus.words(rnd, 400, 10**7)
        alone = units_of(" ".join(middle))
        for n in (1, 30, 77):
            before = corpus.words(rnd, n, 10**7)
            placed = units_of("\n".join([*before, *middle, *corpus.words(rnd, n, 10**7)]))
            inner = {(a, b) for a, b in alone if 25 <= a and b <= 375}
            assert inner and inner <= {(a - n, b - n) for a, b in placed}
        assert all(b - a >= paragraphs.LEAST for a, b in alone)
    both = paragraphs.Paragraphs([b"a b c", " ".join(middle).encode(), b"", b"x " * 30])
    mine = [(a, b) for a, b, t in zip(both.first, both.last, both.text, strict=True) if t == 1]
    assert {(int(a) - 3, int(b) - 3) for a, b in mine} >= set(alone)


def all_pairs(texts):
    """Documents with a paragraph of a component that a smaller id has, by the Jaccard of all pairs."""
    nodes = []
    for i, text in enumerate(texts):
        words = (text or "").lower().split()
        for a, b in units_of(text or ""):
            nodes.append((i, frozenset(tuple(words[x : x + 5]) for x in range(a, b - 4))))
    parent = list(range(len(nodes)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (_, s) in enumerate(nodes):
        for y, (_, t) in enumerate(nodes[:x]):
            both = len(s & t)
            if both and 100 * both >= 80 * (len(s) + len(t) - both):
                parent[root(x)] = root(y)
    owner, out = {}, {}
    for x, (i, _) in enumerate(nodes):
        owner[root(x)] = min(i, owner.get(root(x), i))
    for x, (i, _) in enumerate(nodes):
        if owner[root(x)] < i:
            out.setdefault(i, set()).add(owner[root(x)])
    return out


def test_near_copies_against_all_pairs(spark):
    """Near copies as lines, inside longer lines and wrapped over short lines."""
    rnd = random.Random(9)
    texts = [None, ""]
    for _ in range(40):
        passage = " ".join(corpus.words(rnd, rnd.choice([60, 120, 200]), 10**7))
        for copy in range(rnd.choice([2, 3])):
            mine = corpus.edited(rnd, passage, rnd.choice([0.005, 0.01, 0.015, 0.02])) if copy else passage
            before, after = (" ".join(corpus.words(rnd, rnd.randrange(60), 10**7)) for _ in range(2))
            shape = rnd.randrange(3)
            if shape == 0:
                mine = f"\n{mine}\n"
            if shape == 2:
                mine = "".join(w + ("\n" if rnd.random() < 0.15 else " ") for w in mine.split())
            texts.append(f"{before} {mine} {after}")
    want = all_pairs(texts)
    got = {i: set(r["owners"]) for i, r in rows(paragraphs.kept(corpus.frame(spark, texts))).items()}
    pairs = [(i, o) for i, owners in want.items() for o in owners]
    assert len(pairs) > 35
    assert sum(o in got[i] for i, o in pairs) >= 0.95 * len(pairs)
    # besides them, only documents that share windows
    assert all(got[i] <= want.get(i, set()) | {o for o in range(i)} for i in got)
    assert not got[0] and not got[1]


def test_hot_passages_long_texts_and_extra_columns(spark):
    rnd = random.Random(10)
    passage = " ".join(corpus.words(rnd, 70, 10**7))
    long = " ".join(corpus.words(rnd, 30_000, 10**7))
    texts = [f"{' '.join(corpus.words(rnd, 30, 10**7))} {passage}" for _ in range(300)] + [long, "x " * 20_000, f"{long}\nend"]
    docs = corpus.frame(spark, texts).selectExpr("*", "1 doc", "2 th", "3 first", "4 spans", "5 unit")
    got = rows(paragraphs.kept(docs))
    assert not got[0]["owners"] and got[0]["n_shared"]
    assert all(got[i]["owners"] == [0] and bytes(got[i]["kept"]).decode().split() == texts[i].split()[:30] for i in range(1, 300))
    assert not got[300]["owners"] and got[302]["owners"] == [300] and bytes(got[302]["kept"]).split() == [b"end"]


def test_no_link_is_left_out(spark):
    """Lines at exactly 80 %, and groups whose members are linked through few of
    them: a line goes whenever the Jaccard of all pairs links it to a smaller id."""
    rnd = random.Random(11)
    lines = []
    for _ in range(250):
        line = corpus.words(rnd, 49, 10**7)
        near = list(line)
        near[rnd.randrange(4, 45)] = "other"
        lines += [line, near]  # 40 of 50 shingles
    for _ in range(3):
        line = corpus.words(rnd, 84, 10**7)
        group = [list(line) for _ in range(60)]
        for i, mine in enumerate(group):
            for at in rnd.sample(range(4, 80), rnd.choice([1, 2])):
                mine[at] = f"new{i}"
        lines += [*group, line]
    rnd.shuffle(lines)
    sets = [{tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in lines]
    root = list(range(len(lines)))
    changed = True
    linked = [(i, j) for i, s in enumerate(sets) for j, t in enumerate(sets[:i]) if (n := len(s & t)) and 100 * n >= 80 * len(s | t)]
    while changed:
        changed = False
        for i, j in linked:
            low = min(root[i], root[j])
            changed |= (root[i], root[j]) != (low, low)
            root[i] = root[j] = low
    got = rows(paragraphs.kept(corpus.frame(spark, [f"tail{i}\n{' '.join(x)}" for i, x in enumerate(lines)])))
    assert {i for i in got if bytes(got[i]["kept"]).split() == [b"tail%d" % i]} == {i for i in range(len(lines)) if root[i] < i}


def test_entries_of_a_bucket():
    """No pair at the threshold is dropped, whatever the size of its buckets."""
    rnd = random.Random(12)
    texts = []
    for _ in range(12):
        line = corpus.words(rnd, rnd.choice([26, 49, 90, 1200]), 10**7)
        texts += [" ".join(line)]
        for _ in range(rnd.choice([1, 3, 90])):
            texts.append(corpus.edited(rnd, " ".join(line), rnd.choice([0, 0.01, 0.02])) if rnd.random() < 0.7 else " ".join(line[rnd.randrange(6) :]))
    texts = sorted({x for x in texts})
    common = paragraphs.Paragraphs([t.encode() for t in texts])
    value, at = paragraphs.arrays.grams(common.words.hashes(), common.words.text, 5)
    often = paragraphs.np.unique(paragraphs.ordered(value, None))[::3]
    for known in (None, (often, paragraphs.np.arange(len(often)) % 3 + 1)):
        found = paragraphs.Paragraphs([t.encode() for t in texts], known)
        lines = [i for i in range(len(found.sig)) if found.line[i]]
        assert [int(found.text[i]) for i in lines] == list(range(len(texts)))
        start = paragraphs.np.cumsum(found.n_keys) - found.n_keys
        entries = []
        for x, i in enumerate(lines):
            n = int(found.sig[i, 0])
            for rank, key in enumerate(found.keys[start[i] : start[i] + found.n_keys[i]].tolist()):
                entries.append((key << 20 | min(n, 1023) << 10 | (rank if n < 1023 else 0), x))
        packed, unit = (paragraphs.np.array(c, dtype=paragraphs.np.int64) for c in zip(*sorted(entries), strict=True))
        a, b, key, listed = paragraphs._pairs_of(packed, unit)
        assert listed.any() and not listed.all()
        have = {(x, y) for x, y, one in zip(a.tolist(), b.tolist(), listed, strict=True) if one}
        dense = {}
        for y, k, one in zip(b.tolist(), key.tolist(), listed, strict=True):
            if not one:
                dense.setdefault(k, set()).add(y)
        words = [t.split() for t in texts]
        sets = [{tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in words]
        want = [(i, j) for j, s in enumerate(sets) for i, t in enumerate(sets[:j]) if 100 * len(s & t) >= 80 * len(s | t)]
        assert len(want) > 20
        for i, j in want:
            assert (i, j) in have or any(i in d and j in d for d in dense.values())
            s, t = (found.sig[lines[x]] for x in (i, j))
            differ = sum(bin(int(s[h]) ^ int(t[h])).count("1") for h in (1, 2))
            assert differ * 180 <= 20 * int(s[0] + t[0])


def test_entries_travel_in_slices():
    """Every key of every paragraph makes one entry, in the row of its slice."""
    np, pa = paragraphs.np, paragraphs.pa
    rnd = random.Random(13)
    sizes = [16, 26, 300, paragraphs.FULL + 200]
    keys = [[rnd.randrange(1 << 44) for _ in range(n // 5)] for n in sizes] + [[]]
    rows = {"unit": pa.array([-7, 8, 9, 1 << 62, 5]), "n": pa.array([*sizes, 1], pa.int32()), "keys": [b"".join(k.to_bytes(6, "little") for k in x) for x in keys]}
    got = []
    for batch in paragraphs._entries(iter([pa.RecordBatch.from_pydict(rows)] * 2)):
        assert len(set(batch.column("slice").to_pylist())) == batch.num_rows
        for part, entries in zip(batch.column("slice").to_pylist(), batch.column("entries").to_pylist(), strict=True):
            packed, unit = np.frombuffer(entries, "<i8").reshape(-1, 2).T
            key = (packed >> 20).view(np.uint64) & np.uint64((1 << 44) - 1)
            assert set((paragraphs.arrays.mix(key) % np.uint64(paragraphs.SLICES)).tolist()) == {part}
            got += zip(key.tolist(), (packed >> 10 & 1023).tolist(), (packed & 1023).tolist(), unit.tolist(), strict=True)
    want = [(k, min(n, 1023), i if n < 1023 else 0, u) for u, n, x in zip([-7, 8, 9, 1 << 62], sizes, keys, strict=False) for i, k in enumerate(x)]
    assert sorted(got) == sorted(want * 2)
