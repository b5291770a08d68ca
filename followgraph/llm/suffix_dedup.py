"""Operator 3, suffix-array dedup: repeated strings of ``LENGTH`` bytes.

Removed is each byte that lies in a string of ``LENGTH`` bytes which also
starts in a document with a smaller id.  Sorting every suffix of a corpus
would shuffle it many times over, so the suffix arrays are sparse, without
missing a match:

1. Anchors.  In every string of ``LENGTH`` bytes the smallest hash of its
   ``GRAM``-byte grams marks an anchor.  Equal strings have equal anchors at
   equal places, so it is enough to compare strings around anchors; about
   one byte in 14 is one.  Documents are handled in blocks, by a hash of the
   id.
2. Blocks send the hashes of their anchors (five bytes each, once for each
   block) to ranges of the hash space, and learn which occur in two or more
   documents: a bit for each hash, in the order they were sent.
3. For those, blocks send the text around the anchor, as far as the strings
   go that it marks (in which no hash is smaller): once for each different
   surrounding, with the smallest id that has it.
4. A range is dealt into buckets of about ``SITES`` sites, by the gram.  In a
   bucket, the suffixes that start at the anchors are mergesorted.  Two
   suffixes are compared in logarithmic time: binary search over prefix
   hashes finds how far they agree, the next byte decides.  Extensions of
   neighbours are verified byte by byte.  Runs of the suffix array that
   agree far enough to the right, grouped by what stands to the left, are
   the equal strings; the smallest id of each tells what to remove.
5. Blocks learn the stretch to remove around each anchor they sent.

There are as many ranges as blocks, and a message for each block and range
that have anchors in common.  Blocks and ranges grow with the corpus up to
``MOST_BYTES`` of text, so that messages stay few and large.

Anchors that occur in more than ``HOT`` documents send their strings one by
one, dealt by the hash of the string instead of the anchor; equal ones
count once for each block.  So no task gathers all surroundings of a
frequent line.

A null text is empty.  A null id counts as larger than all others, so such
rows remove nothing from one another.  Rows that repeat an id do not remove
from one another.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from followgraph.llm import arrays, ship

LENGTH = 50
GRAM = 24
BLOCK_BYTES = 5 << 20  # least text of a block
BLOCKS = 256  # beyond so many, blocks grow
MOST_BYTES = 16 << 20  # most text of a block
SITES = 1 << 14  # of a bucket
SLICE = 1 << 18  # bytes hashed at once
HOT = 1500
LAST = np.iinfo(np.int64).max  # stands for a null id

LEFT = LENGTH - GRAM  # bytes before an anchor that a string can hold
ROW = LEFT + LENGTH

_VALUE = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _accumulated(factor: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), factor, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class PrefixHashes:
    """Hashes of all substrings of a byte string from one running sum."""

    powers = (_accumulated(_BASE, 0), _accumulated(_INVERSE, 0))  # of the longest string so far, up to a few slices

    def __init__(self, data: np.ndarray):
        n = len(data)
        power, inverse = PrefixHashes.powers
        if len(power) <= n:
            power, inverse = _accumulated(_BASE, n + SLICE), _accumulated(_INVERSE, n + SLICE)
            if n <= 4 * SLICE:
                PrefixHashes.powers = power, inverse
        self.power = power
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_VALUE[data] * inverse[:n], out=self.sums[1:])

    def get(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.power[start]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash for each run of ``GRAM`` bytes, put together from runs of powers of two."""
    out, width = None, 0
    run, span, factor = _VALUE[data], 1, _BASE  # of ``span`` bytes; factor: the base to that power
    while True:
        if GRAM & span:
            out = run if out is None else out[: len(run) - width] * factor + run[width:]
            width += span
        if width == GRAM:
            return arrays.mix(out)
        run = run[:-span] * factor + run[span:]
        span *= 2
        factor = np.uint64(int(factor) ** 2 % (1 << 64))


def sliding(op, x: np.ndarray, width: int) -> np.ndarray:
    """``op`` over every window of ``width`` values, by doubling."""
    span = 1
    while span * 2 <= width:
        x = op(x[:-span], x[span:])
        span *= 2
    return op(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


class Anchors:
    """Every anchor of some texts, in the order of texts and places.

    ``text`` and ``at`` tell where it is, ``gram`` is the hash of its gram; the strings
    that it marks reach from ``left`` bytes before it to ``right`` bytes after its start.
    """

    def __init__(self, texts: list[bytes]):
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.uint8))]
        width = LENGTH - GRAM + 1
        for a, b in arrays.slices(texts, SLICE):
            data = np.frombuffer(b"".join(texts[a:b]), dtype=np.uint8)
            n = len(data)
            if n < LENGTH:
                continue
            length = np.fromiter(map(len, texts[a:b]), dtype=np.int64, count=b - a)
            end = np.cumsum(length)
            gram = gram_hashes(data)
            rank = (gram >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
            low = sliding(np.minimum, rank, width)
            # Strings that would run beyond their text do not count.
            low[np.repeat(end, length)[: len(low)] < np.arange(LENGTH, LENGTH + len(low))] = 0
            edge = np.zeros(width - 1, dtype=np.uint32)
            best = sliding(np.maximum, np.concatenate([edge, low, edge]), width)
            at = np.flatnonzero(best == rank)
            text = np.searchsorted(end, at, side="right")
            # The strings of an anchor start one after another: the last run of its minimum up to it.
            start = np.append(np.flatnonzero(np.append(True, low[1:] != low[:-1])), len(low))
            run = np.searchsorted(start, np.minimum(at, len(low) - 1), side="right") - 1
            value, least = low[start[:-1]], rank[at]
            open_ = np.flatnonzero(value[run] != least)
            while len(open_):
                run[open_] -= 1
                open_ = open_[value[run[open_]] != least[open_]]
            left = np.minimum(at - start[run], LEFT)
            right = np.minimum(start[run + 1] - 1 - at, 0) + LENGTH
            # Anchors have small hashes; mixed once more, they spread evenly over the ranges.
            parts.append((text + a, at - (end - length)[text], arrays.mix(gram[at]), left.astype(np.uint8), right.astype(np.uint8)))
        self.text, self.at, self.gram, self.left, self.right = (np.concatenate(x) for x in zip(*parts, strict=True))


def range_of(key: np.ndarray, ranges: int) -> np.ndarray:
    """Equal ranges of the hash space, so that sorted hashes fall into them in order."""
    return ((key >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def packed(key: np.ndarray) -> bytes:
    """Bits 16 to 55 of each hash; the range has the top ones."""
    return np.ascontiguousarray((key >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


class Keys:
    """Different anchor hashes of a block and the documents that have them.

    ``key`` are the hashes, rising; ``docs`` their numbers of documents, up to
    255; those of range ``r`` stand from ``edge[r]`` on.  Equal hashes follow one another in
    ``order``, a permutation of the anchors, as often as ``times`` tells.
    """

    def __init__(self, ids: np.ndarray, found: Anchors, ranges: int):
        """``ids`` rise."""
        self.order = np.argsort(found.gram, kind="stable")
        gram, doc = found.gram[self.order], ids[found.text[self.order]]
        new = np.ones(len(gram), dtype=bool)
        new[1:] = gram[1:] != gram[:-1]
        first = np.flatnonzero(new)
        self.key = gram[first]
        self.times = np.diff(np.append(first, len(gram)))
        new[1:] |= doc[1:] != doc[:-1]
        self.docs = np.minimum(np.add.reduceat(new, first, dtype=np.int64) if len(first) else first, 255).astype(np.uint8)
        self.edge = np.searchsorted(range_of(self.key, ranges), np.arange(ranges + 1))

    def messages(self) -> list[tuple[int, bytes, bytes]]:
        """``(range, hashes, documents)``."""
        data, docs = packed(self.key), self.docs.tobytes()
        edge = self.edge.tolist()
        return [(r, data[5 * a : 5 * b], docs[a:b]) for r, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if a < b]

    def kinds(self, shared: list[tuple[int, bytes]]) -> np.ndarray:
        """Of each anchor, from the ranges' answers: 1 for a shared one, 2 for a frequent one, or 0."""
        kind = np.zeros(len(self.key), dtype=np.int8)
        for r, bits in shared:
            a, b = self.edge[r], self.edge[r + 1]
            kind[a:b] = np.unpackbits(np.frombuffer(bits, dtype=np.uint8).reshape(2, -1), axis=1, count=b - a).sum(axis=0)
        out = np.empty(len(self.order), dtype=np.int8)
        out[self.order] = np.repeat(kind, self.times)
        return out


def shared_keys(blocks: list[tuple[int, bytes, bytes]], hot: int) -> list[tuple[int, bytes]]:
    """``(block, bits)``: of the hashes ``(block, hashes, documents)`` sent to a range, a
    bit for those that two documents or more have, then one for those of more than ``hot``."""
    count = [len(c) for *_, c in blocks]
    every = unpacked(b"".join(k for _, k, _ in blocks))
    order = np.argsort(every)
    every = every[order]
    first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    docs = np.frombuffer(b"".join(c for *_, c in blocks), dtype=np.uint8)[order]
    total = np.empty(len(order), dtype=np.int64)
    total[order] = np.repeat(np.add.reduceat(docs, first, dtype=np.int64), np.diff(np.append(first, len(order))))
    out, at = [], 0
    for (block, _, _), n in zip(blocks, count, strict=True):
        own = total[at : at + n]
        at += n
        if (own >= 2).any():
            out.append((block, np.packbits([own >= 2, (own >= 2) & (own > hot)], axis=1).tobytes()))
    return out


class Sites:
    """Surroundings of the shared anchors of a block.

    ``place`` is the anchor (or the string's start) in the joined texts,
    ``left`` and ``right`` the bytes before and from it that belong to it, and
    ``rep`` the site that stands for all equal ones, that of the smallest id.
    """

    def __init__(self, ids: np.ndarray, texts: list[bytes], shared: list[tuple[int, bytes]], ranges: int):
        self.ids = ids
        length = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.begin = np.concatenate(([0], np.cumsum(length)))
        self.data = np.frombuffer(b"".join([bytes(LEFT), *texts, bytes(ROW)]), dtype=np.uint8)
        found = Anchors(texts)
        kind = Keys(ids, found, ranges).kinds(shared)
        few, many = np.flatnonzero(kind == 1), np.flatnonzero(kind == 2)
        place = self.begin[found.text] + found.at
        # Frequent anchors: the strings themselves, each once for each place.
        shift = np.arange(LEFT + 1)
        fits = (shift <= found.left[many][:, None]) & (LENGTH - shift <= found.right[many][:, None])
        single = np.unique((place[many][:, None] - shift)[fits])
        self.place = np.concatenate([place[few], single])
        self.text = np.concatenate([found.text[few], np.searchsorted(self.begin, single, side="right") - 1])
        self.left = np.concatenate([found.left[few], np.zeros(len(single), np.uint8)]).astype(np.int64)
        self.right = np.concatenate([found.right[few], np.full(len(single), LENGTH, np.uint8)]).astype(np.int64)
        gram = np.concatenate([found.gram[few], np.zeros(len(single), np.uint64)])
        alone = np.arange(len(self.place)) >= len(few)
        del found, kind, place, fits
        if alone.any():
            by = np.argsort(self.place, kind="stable")
            self.place, self.text, self.left, self.right, alone, gram = (x[by] for x in (self.place, self.text, self.left, self.right, alone, gram))
        whole = self.hashes()
        route = range_of(np.where(alone, whole, gram), ranges)
        # Ids rise with places, so of equal surroundings the first has the smallest.
        order = np.argsort(whole, kind="stable")
        new = np.ones(len(order), dtype=bool)
        new[1:] = whole[order][1:] != whole[order][:-1]
        self.rep = np.empty(len(order), dtype=np.int64)
        self.rep[order] = order[new][np.cumsum(new) - 1] if len(order) else order
        sent = order[new]  # by range and hash, the same whenever it is computed
        by = np.argsort(route[sent], kind="stable")
        self.sent = sent[by]
        self.edge = np.searchsorted(route[self.sent], np.arange(ranges + 1))

    def hashes(self) -> np.ndarray:
        """A hash for the bytes around each site, a slice of the texts at a time."""
        out = np.empty(len(self.place), dtype=np.uint64)
        start, end = self.place - self.left + LEFT, self.place + self.right + LEFT
        a = 0
        while a < len(out):
            b = max(a + 1, int(np.searchsorted(self.place, self.place[a] + SLICE)))
            low = start[a:b].min()
            sums = PrefixHashes(self.data[low : end[a:b].max()])
            out[a:b] = sums.get(start[a:b] - low, end[a:b] - low)
            a = b
        return arrays.mix(out + (self.left * 64 + self.right).astype(np.uint64))

    def rows(self, sites: np.ndarray) -> np.ndarray:
        """Bytes around sites, the anchor in column ``LEFT``, zeros outside."""
        out = np.lib.stride_tricks.sliding_window_view(self.data, ROW)[self.place[sites]]
        left, right = self.left[sites], self.right[sites]
        part = np.flatnonzero((left < LEFT) | (right < LENGTH))
        column = np.arange(ROW) - LEFT
        out[part] *= (column >= -left[part][:, None]) & (column < right[part][:, None])
        return out

    def messages(self) -> list[tuple[int, bytes]]:
        """``(range, data)``: ids, left, right and rows of the sites that stand for others."""
        out = []
        for r in np.flatnonzero(np.diff(self.edge)):
            own = self.sent[self.edge[r] : self.edge[r + 1]]
            out.append((int(r), squeezed(self.ids[self.text[own]], self.left[own], self.right[own], self.rows(own))))
        return out

    def removed(self, answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, start and end (in the text) of the stretches that go, from the ranges'
        answers, rising; stretches that meet are one."""
        before = np.zeros(len(self.place), dtype=np.int64)
        after = np.zeros(len(self.place), dtype=np.int64)
        for r, data in answers.items():
            own = self.sent[self.edge[r] : self.edge[r + 1]]
            before[own], after[own] = np.frombuffer(data, dtype=np.uint8).reshape(2, -1)
        doc = self.ids[self.text]
        # A larger id with the same surroundings as a smaller one in this block loses all of it.
        whole = doc > doc[self.rep]
        before = np.where(whole, self.left, before[self.rep])
        after = np.where(whole, self.right, after[self.rep])
        some = np.flatnonzero(after > 0)
        text, start, end = self.text[some], (self.place - before)[some], (self.place + after)[some]
        order = np.argsort(start, kind="stable")  # texts stand one after another
        text, start, end = text[order], start[order], np.maximum.accumulate(end[order])
        new = np.ones(len(order), dtype=bool)
        new[1:] = (start[1:] > end[:-1]) | (text[1:] != text[:-1])
        base = self.begin[text[new]]
        return text[new], start[new] - base, end[np.append(np.flatnonzero(new)[1:], len(order))[: new.sum()] - 1] - base


def squeezed(doc: np.ndarray, left: np.ndarray, right: np.ndarray, rows: np.ndarray) -> bytes:
    """Sites as one compressed message after their number."""
    data = b"".join([doc.astype("<i8").tobytes(), left.astype(np.uint8).tobytes(), right.astype(np.uint8).tobytes(), rows.tobytes()])
    return len(doc).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def spread(message: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, left, right and rows of a message."""
    n = int.from_bytes(message[:8], "little")
    data = pa.decompress(message[8:], decompressed_size=n * (10 + ROW), codec="zstd", asbytes=True)
    side = np.frombuffer(data, np.uint8, 2 * n, 8 * n).reshape(2, -1).astype(np.int64)
    return np.frombuffer(data, "<i8", n), side[0], side[1], np.frombuffer(data, np.uint8, n * ROW, 10 * n).reshape(-1, ROW)


def extension(sums: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """How far suffixes ``a`` and ``b`` agree: binary search for the longest equal prefix hash."""
    low = np.zeros(len(a), dtype=np.int64)
    high = np.full(len(a), most)
    while True:
        mid = (low + high + 1) // 2
        if (low == high).all():
            return low
        same = sums[a, mid] == sums[b, mid]
        low = np.where(same, mid, low)
        high = np.where(same, high, np.maximum(mid - 1, low))


def sorted_suffixes(suffix: np.ndarray, sums: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of the suffixes by group and content: bottom-up mergesort of all
    groups at once; each element finds its rank in the other run by binary search."""
    most = suffix.shape[1]

    def less(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        far = extension(sums, a, b, most)
        end = far == most
        at = np.minimum(far, most - 1)
        return np.where(end, a < b, suffix[a, at] < suffix[b, at])  # ties by number: a total order

    order = np.argsort(group, kind="stable")
    head = np.flatnonzero(np.diff(group[order], prepend=-1))
    start = np.repeat(head, np.diff(np.append(head, len(order))))
    stop = np.repeat(np.append(head, len(order))[1:], np.diff(np.append(head, len(order))))
    rank = np.arange(len(order)) - start
    run = 1
    size = stop - start
    while (size > run).any():
        todo = np.flatnonzero(size > run)
        own = rank[todo] // run
        other = start[todo] + (own ^ 1) * run
        low = np.minimum(other, stop[todo])
        first = low.copy()
        high = np.minimum(other + run, stop[todo])
        while True:
            open_ = low < high
            if not open_.any():
                break
            mid = (low + high) // 2
            t = np.flatnonzero(open_)
            before = less(order[mid[t]], order[todo[t]])
            low[t] = np.where(before, mid[t] + 1, low[t])
            high[t] = np.where(before, high[t], mid[t])
        target = start[todo] + (own // 2) * 2 * run + rank[todo] % run + (low - first)
        moved = order.copy()
        moved[target] = order[todo]
        order = moved
        run *= 2
    return order


def _prefix_sums(rows: np.ndarray) -> np.ndarray:
    out = np.zeros((rows.shape[0], rows.shape[1] + 1), dtype=np.uint64)
    for j in range(rows.shape[1]):
        out[:, j + 1] = out[:, j] * _BASE + _VALUE[rows[:, j]]
    return out


def row_kinds(rows: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number for each site, equal for equal surroundings."""
    full = np.zeros((len(rows), -(-(ROW + 2) // 8) * 8), dtype=np.uint8)
    full[:, :ROW], full[:, ROW], full[:, ROW + 1] = rows, left, right
    words = full.view(np.uint64)
    _, first, kind = np.unique(word_hashes(words), return_index=True, return_inverse=True)
    if (words != words[first[kind]]).any():  # a collision
        _, kind = np.unique(full.view(f"V{full.shape[1]}").ravel(), return_inverse=True)
    return kind


def word_hashes(words: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words), dtype=np.uint64)
    for j in range(words.shape[1]):
        out = arrays.mix(out * _BASE + words[:, j])
    return out


def stretches(doc: np.ndarray, left: np.ndarray, right: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes to remove before and from each anchor: the union of its strings
    that a smaller id has too; 0 and 0 for none."""
    n = len(doc)
    before, after = np.zeros(n, np.int64), np.zeros(n, np.int64)
    gram = word_hashes(np.ascontiguousarray(rows[:, LEFT : LEFT + GRAM]).view(np.uint64))
    bucket = gram % np.uint64(-(-n // SITES))
    order = np.argsort(bucket, kind="stable")
    cuts = [0, *(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), n]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own = order[a:b]
        before[own], after[own] = _stretches(doc[own], left[own], right[own], rows[own], gram[own])
    return before, after


def _stretches(doc: np.ndarray, left: np.ndarray, right: np.ndarray, rows: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(doc)
    before, after = np.zeros(n, np.int64), np.zeros(n, np.int64)
    # Equal surroundings first: only the smallest id of each has something left to find.
    kind = row_kinds(rows, left, right)
    order = np.lexsort((doc, kind))
    lead = np.ones(n, dtype=bool)
    lead[1:] = kind[order][1:] != kind[order][:-1]
    best = doc[order[lead]]  # by kind
    whole = (doc > best[kind]) & (left + right >= LENGTH)
    before[whole], after[whole] = left[whole], right[whole]
    one = order[lead]  # by kind, the first of its smallest id
    _, group, count = np.unique(gram[one], return_inverse=True, return_counts=True)
    several = count[group] > 1
    one, group = one[several], group[several]
    if not len(one):
        return before, after
    suffix = rows[one][:, LEFT:]
    sums = _prefix_sums(suffix)
    place = sorted_suffixes(suffix, sums, group)
    one, suffix, group, sums = one[place], suffix[place], group[place], sums[place]
    agree = extension(sums, np.arange(len(one) - 1), np.arange(1, len(one)), LENGTH)
    equal = suffix[1:] == suffix[:-1]
    exact = np.where(equal.all(axis=1), LENGTH, equal.argmin(axis=1))
    agree = np.minimum(agree, exact)  # verification: a collision of hashes cannot lengthen it
    agree[group[1:] != group[:-1]] = 0
    back = np.ascontiguousarray(rows[one][:, LEFT - 1 :: -1])
    back_sums = _prefix_sums(back).T.copy()
    first = np.full(len(one), LENGTH + 1)
    last = np.full(len(one), -1)
    by_doc = np.argsort(doc[one], kind="stable")
    lefts, rights = left[one][by_doc], right[one][by_doc]
    for o in range(LEFT + 1):
        segment = np.concatenate(([0], np.cumsum(agree < LENGTH - o)))
        size = np.bincount(segment)
        fits = (lefts >= o) & (rights >= LENGTH - o) & (size[segment[by_doc]] > 1)
        ok = by_doc[fits]  # by document, so the first of equal ones has the smallest
        if not len(ok):
            continue
        key = arrays.mix(back_sums[o, ok] + segment[ok].astype(np.uint64) * _BASE)
        same = np.argsort(key, kind="stable")
        ok, key = ok[same], key[same]
        head = np.ones(len(ok), dtype=bool)
        head[1:] = key[1:] != key[:-1]
        leader = ok[head][np.cumsum(head) - 1]
        hit = np.flatnonzero((doc[one[leader]] < doc[one[ok]]) & (segment[leader] == segment[ok]))
        hit = hit[(back[leader[hit], :o] == back[ok[hit], :o]).all(axis=1)]  # verified
        covered = ok[hit]
        first[covered] = np.minimum(first[covered], o)
        last[covered] = o
    found = (last >= 0) & (after[one] == 0)
    before[one[found]] = last[found]
    after[one[found]] = LENGTH - first[found]
    # A row of equal surroundings and the same smallest id has the same stretch.
    lead = order[lead]
    rest = doc == best[kind]
    before[rest], after[rest] = before[lead[kind[rest]]], after[lead[kind[rest]]]
    return before, after


REPLY = "block int, range int, kind int, data binary, mark binary"
KEPT = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _reply(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["block", "range", "kind", "data", "mark"])


def _block(table: pa.Table) -> tuple[np.ndarray, list[bytes], int]:
    """Ids (null: the largest) and texts of a block, by id, in an order of their own, and its number."""
    ids = table.column("doc_id").fill_null(int(LAST)).to_numpy()
    texts = arrays.texts_of(table.column("text"))
    order = sorted(range(len(texts)), key=lambda i: (ids[i], texts[i]))
    return ids[order], [texts[i] for i in order], table.column("block")[0].as_py()


def block_count(size: int) -> int:
    """Blocks, and ranges of the hash space, for so many bytes of text.

    A block and a range exchange one message, so the number of messages is the
    square of this: blocks grow as soon as there are ``BLOCKS`` of them.
    """
    each = max(BLOCK_BYTES, min(size // BLOCKS, MOST_BYTES))
    return max(1, -(-size // each))


def _cut(texts: list[bytes], text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The stretches of each text, and what they leave of it."""
    edge = np.searchsorted(text, np.arange(len(texts) + 1))
    spans = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.StructArray.from_arrays([pa.array(start), pa.array(end)], names=["start", "end"]))
    start, end, edge, rest = start.tolist(), end.tolist(), edge.tolist(), []
    for t, a, b in zip(texts, edge[:-1], edge[1:], strict=True):
        rest.append(b"".join([t[p:q] for p, q in zip([0, *end[a:b]], [*start[a:b], len(t)], strict=True)]) if a < b else t)
    return spans, pa.array(rest, pa.binary())


def kept(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, spans`` (byte ranges removed) and ``kept`` (the rest) of every row."""
    ship.package(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    blocks, hot = block_count(size), HOT
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
    number = F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(blocks)).cast("int")
    rows = rows.select("doc_id", "text", number.alias("block"))

    def keys(table: pa.Table) -> pa.Table:
        ids, texts, block = _block(table)
        return _reply([(block, r, 0, k, c) for r, k, c in Keys(ids, Anchors(texts), blocks).messages()])

    def answer_keys(table: pa.Table) -> pa.Table:
        here = table.column("range")[0].as_py()
        sent = zip(*(table.column(c).to_pylist() for c in ("block", "data", "mark")), strict=True)
        return _reply([(block, here, 0, bits, None) for block, bits in shared_keys(list(sent), hot)])

    def sites(table: pa.Table, replies: pa.Table) -> tuple[Sites, np.ndarray, list[bytes], int]:
        ids, texts, block = _block(table)
        told = zip(*(replies.column(c).to_pylist() for c in ("range", "data", "kind")), strict=True)
        return Sites(ids, texts, [(r, bits) for r, bits, kind in told if kind == 0], blocks), ids, texts, block

    def surroundings(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows or not replies.num_rows:
            return _reply([])
        found, _, _, block = sites(table, replies)
        return _reply([(block, r, 1, data, None) for r, data in found.messages()])

    def answer_sites(table: pa.Table) -> pa.Table:
        here, block, data = table.column("range")[0].as_py(), table.column("block").to_pylist(), table.column("data").to_pylist()
        parts = [spread(d) for d in data]
        doc, left, right, around = (np.concatenate(x) for x in zip(*parts, strict=True))
        count = [len(x[0]) for x in parts]
        del parts, data
        before, after = stretches(doc, left, right, around)
        cut = np.cumsum([0, *count])
        return _reply([(x, here, 1, np.stack([before[a:b], after[a:b]]).astype(np.uint8).tobytes(), None) for x, a, b in zip(block, cut[:-1], cut[1:], strict=True)])

    def cleaned(table: pa.Table, replies: pa.Table) -> pa.Table:
        names = ["doc_id", "n_bytes", "spans", "kept"]
        if not table.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), SPANS, pa.binary())], names=names)
        found, ids, texts, _ = sites(table, replies)
        told = zip(*(replies.column(c).to_pylist() for c in ("range", "data", "kind")), strict=True)
        spans, rest = _cut(texts, *found.removed({r: d for r, d, k in told if k == 1}))
        own = pa.array(ids, pa.int64(), mask=ids == LAST)
        return pa.table([own, pa.array([len(t) for t in texts], pa.int64()), spans, rest], names=names)

    first = rows.groupBy("block").applyInArrow(keys, REPLY).groupBy("range").applyInArrow(answer_keys, REPLY)
    around = rows.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(surroundings, REPLY)
    second = around.groupBy("range").applyInArrow(answer_sites, REPLY)
    return rows.groupBy("block").cogroup(first.unionByName(second).groupBy("block")).applyInArrow(cleaned, KEPT)
