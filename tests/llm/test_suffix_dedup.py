"""Repeated byte strings against a table of all strings of 50 bytes."""

import hashlib
import random
import time

import numpy as np
import pytest

from followgraph.llm import suffix_dedup as S
from tests.llm import corpus


def brute(rows):
    first = {}
    for i, t in rows:
        data = (t or "").encode()
        for j in range(len(data) - 49):
            key = data[j : j + 50]
            mine = float("inf") if i is None else i
            first[key] = min(first.get(key, mine), mine)
    out = []
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        mine = float("inf") if i is None else i
        for j in range(len(data) - 49):
            if first[data[j : j + 50]] < mine:
                gone[j : j + 50] = b"\1" * 50
        rest = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in df.collect()), key=str)


def passages(seed, count=60):
    """Texts that share passages, cut and shifted, with runs of one letter and other scripts."""
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("abcdé ") for _ in range(rnd.choice([49, 50, 51, 80, 200]))) for _ in range(8)]
    pool += ["x" * 120, "ab" * 60, "日本" * 20]
    texts = []
    for _ in range(count):
        text = ""
        for _ in range(rnd.randrange(6)):
            piece = rnd.choice(pool) if rnd.random() < 0.7 else "".join(rnd.choice("efgh ") for _ in range(rnd.randrange(120)))
            a = rnd.choice([0, 0, rnd.randrange(len(piece) + 1)])
            text += piece[a:]
        texts.append(text)
    return [*texts, None, "", "x" * 49, "x" * 50, "x" * 51]


@pytest.mark.parametrize(("seed", "size", "hot"), [(1, 1 << 20, 1500), (2, 2000, 1500), (3, 2000, 3), (4, 500, 0)])
def test_like_all_strings(spark, monkeypatch, seed, size, hot):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "BLOCK_BYTES", size)
    texts = passages(seed)
    assert result(S.kept(corpus.frame(spark, texts))) == brute(list(enumerate(texts)))


def test_null_and_repeated_ids(spark):
    a, b = "a1 b2 c3 " * 12, "".join(chr(97 + i * 7 % 26) for i in range(90))
    rows = [(None, a), (None, b), (4, b), (4, b), (2, a), (9, a + b), (9, a)]
    assert result(S.kept(corpus.frame(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert result(S.kept(corpus.frame(spark, []))) == []


def test_order_of_suffixes():
    rnd = np.random.default_rng(1)
    rows = rnd.integers(97, 99, (300, 50)).astype(np.uint8)
    rows[100:200] = rows[:100]
    group = rnd.integers(0, 5, 300)
    order = S.sorted_suffixes(rows, S._prefix_sums(rows), group)
    assert order.tolist() == sorted(range(300), key=lambda i: (group[i], rows[i].tobytes(), i))


def in_process(rows, blocks, hot):
    """The messages of ``kept`` passed on by hand: ids, spans and what is left."""
    parts = [sorted(r for r in rows if r[0] % blocks == b) for b in range(blocks)]
    parts = [(np.array([i for i, _ in p], dtype=np.int64), [t for _, t in p]) for p in parts if p]
    asked, told, sent, answers = {}, {}, {}, {}
    for b, (ids, texts) in enumerate(parts):
        for r, keys, docs in S.Keys(ids, S.Anchors(texts), blocks).messages():
            asked.setdefault(r, []).append((b, keys, docs))
    for r, found in asked.items():
        for b, bits in S.shared_keys(found, hot):
            told.setdefault(b, []).append((r, bits))
    sites = [S.Sites(*p, told.get(b, []), blocks) for b, p in enumerate(parts)]
    for b, own in enumerate(sites):
        for r, data in own.messages():
            sent.setdefault(r, []).append((b, S.spread(data)))
    for r, found in sent.items():
        both = np.stack(S.stretches(*(np.concatenate(x) for x in zip(*(x for _, x in found), strict=True))))
        for b, (doc, *_) in found:
            answers.setdefault(b, {})[r] = both[:, : len(doc)].astype(np.uint8).tobytes()
            both = both[:, len(doc) :]
    out = []
    for b, ((ids, texts), own) in enumerate(zip(parts, sites, strict=True)):
        spans, rest = S._cut(texts, *own.removed(answers.get(b, {})))
        out += [(i, len(t), len(t) - len(k), len(s), hashlib.sha256(k).hexdigest()) for i, t, s, k in zip(ids.tolist(), texts, spans.to_pylist(), rest.to_pylist(), strict=True)]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(6))
def test_any_blocks_slices_and_buckets(monkeypatch, seed):
    rnd = random.Random(seed)
    monkeypatch.setattr(S, "SLICE", rnd.choice([60, 1000]))
    monkeypatch.setattr(S, "SITES", rnd.choice([1, 20]))
    texts = [*passages(seed + 10), "\0" * 70 + "a" * 30, "a" * 10 + "\0" * 70]
    rows = [(rnd.choice([i, i, rnd.randrange(9)]), t or "") for i, t in enumerate(texts)]
    for blocks, hot in ((1, 1500), (5, 2), (40, 0)):
        assert in_process([(i, t.encode()) for i, t in rows], blocks, hot) == brute(rows)


def test_strings_marked_by_their_smallest_gram():
    texts = [t.encode() for t in passages(5) if t]
    found = S.Anchors(texts)
    marked = [set() for _ in texts]
    for t, at, left, right in zip(found.text, found.at.tolist(), found.left.tolist(), found.right.tolist(), strict=True):
        marked[t] |= {(s, at) for s in range(at - left, at + right - 49)}
    for t, text in enumerate(texts):
        rank = (S.gram_hashes(np.frombuffer(text, np.uint8)) >> np.uint64(32) | np.uint64(1)).tolist() if len(text) >= 24 else []
        want = set()
        for s in range(len(text) - 49):
            least = min(rank[s : s + 27])
            want |= {(s, at) for at in range(s, s + 27) if rank[at] == least}
        assert marked[t] == want


def test_messages_stay_few_and_large():
    # Bytes of text: 0.1, 0.5 and 6 GB of Parquet; one anchor in 14 bytes.
    for size in (173 << 20, 865 << 20, 10_200 << 20):
        blocks = S.block_count(size)
        assert blocks >= 32
        assert size / 14 / blocks**2 > 1000
        assert size / blocks <= S.MOST_BYTES


def test_ranges_cost_no_scan_of_the_block():
    rnd = np.random.default_rng(2)
    texts = [rnd.integers(97, 123, 4000).astype(np.uint8).tobytes() for _ in range(500)]
    ids, found = np.arange(500), S.Anchors(texts)

    def seconds(ranges):
        began = time.process_time()
        keys = S.Keys(ids, found, ranges)
        told = [(r, np.packbits(np.ones((2, len(docs)), bool) * [[True], [False]], axis=1).tobytes()) for r, _, docs in keys.messages()]
        assert (keys.kinds(told) == 1).all()
        return time.process_time() - began

    seconds(1)
    assert seconds(8000) < 1 + 5 * seconds(1)  # with a scan for each range: seconds
