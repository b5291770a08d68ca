"""Operator 13, periodic runs: words that a text repeats over and over.

A run is a stretch of consecutive words with smallest period ``q`` (words
``q`` apart are equal) and at least ``max(LENGTH, POWER * q)`` words that no
neighbouring word extends.  :func:`collapse` finds all runs of a text and
the text without the words that any run holds after its first ``q``.

Recursive frequency splitting: every word of a run occurs at least
``POWER`` times in it, so a word that occurs less often within its segment
(at first the whole text) is in no run and splits the segment; pieces under
``LENGTH`` words are dropped, the others are split by their own counts until
none changes.  Runs lie whole in surviving segments.

Lag scan of a segment: the words equal to those ``q`` later make a stretch
of ``(POWER - 1) * q`` at least, which covers a whole block ``[k*q, k*q + q)``.
So for every lag only the hashes of neighbouring blocks are compared, about
``n * log(n)`` for all lags of ``n`` words, and equal blocks are extended word
by word in both directions, which also verifies them.  Blocks inside a known
run whose period divides the lag are passed over: their stretch is that run.

Words are ``[^\\x20\\x09-\\x0D]+``, compared by their bytes.  Null, empty and
blank texts have no words and no runs.  Texts are judged one by one, so
repeated rows get equal results, and an empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from followgraph.llm import arrays, ship

LENGTH, POWER = 24, 3
#: Blocks compared at once in a lag scan.
BLOCKS = 1 << 20

_BASE = 0x9E3779B97F4A7C15


def survivors(ids: np.ndarray, segment: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of words left by frequency splitting; ``segment`` (ascending)
    tells the first segments, ``ids`` the words."""
    done = []
    place = np.arange(len(ids))
    width = int(ids.max(initial=0)) + 1
    while len(place):
        key = segment * width + ids[place]
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        often = count[inverse] >= POWER
        stays = place[often]
        if not len(stays):
            break
        old = segment[often]
        cut = np.flatnonzero((np.diff(stays) != 1) | (np.diff(old) != 0)) + 1
        start = np.concatenate(([0], cut))
        length = np.diff(np.append(start, len(stays)))
        whole = length == np.bincount(segment, minlength=int(segment[-1]) + 1)[old[start]]
        enough = length >= LENGTH
        done += [(int(stays[s]), int(stays[s]) + int(n)) for s, n in zip(start[whole & enough], length[whole & enough])]
        again = enough & ~whole
        member = np.repeat(again, length)
        place = stays[member]
        segment = np.repeat(np.arange(int(again.sum())), length[again])
    return sorted(done)


def reach(x: np.ndarray, at: int, lag: int, back: bool) -> int:
    """How many words from ``at`` on (or before it) equal those ``lag`` later."""
    total, size = 0, 32
    limit = at if back else len(x) - lag - at
    while total < limit:
        n = min(size, limit - total)
        a = at - total - n if back else at + total
        unequal = np.flatnonzero(x[a : a + n] != x[a + lag : a + lag + n])
        if len(unequal):
            return total + int(n - 1 - unequal[-1] if back else unequal[0])
        total += n
        size *= 2
    return total


def lag_scan(x: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs of a segment as ``(start, length, period)``."""
    n = len(x)
    most = n // POWER
    power = np.full(n + 1, _BASE, dtype=np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    total = np.zeros(n + 1, dtype=np.uint64)  # of hash * power, so a block `lag` later compares after one product
    np.cumsum(arrays.mix(x.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    runs: list[tuple[int, int, int]] = []
    low = 1
    while low <= most:
        high = min(2 * low, most + 1)
        high = low + max(1, min(high - low, BLOCKS * low // n))
        lags = np.arange(low, high)
        pairs = n // lags - 1
        lag = np.repeat(lags, pairs)
        block = (np.arange(len(lag)) - np.repeat(np.cumsum(pairs) - pairs, pairs)) * lag
        middle = total[block + lag]
        same = (middle - total[block]) * power[lag] == total[block + 2 * lag] - middle
        lag, block = lag[same], block[same]
        for start, length, period in runs:
            if not len(lag):
                break
            known = (block >= start) & (block + 2 * lag <= start + length) & (lag % period == 0)
            lag, block = lag[~known], block[~known]
        before, end = 0, 0
        for q, at in zip(lag.tolist(), block.tolist()):
            if q == before and at < end:
                continue
            after = reach(x, at, q, back=False)
            start = at - reach(x, at, q, back=True)
            before, end = q, at + after
            length = end + q - start
            if length >= max(LENGTH, POWER * q):
                runs.append((start, length, q))
        low = high
    return runs


def find(texts: list[bytes]) -> list[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words and runs, by start and period, of every text."""
    words = [x.split() for x in texts]  # bytes are split at the six separators
    count = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in chain.from_iterable(words)), dtype=np.int64, count=int(count.sum()))
    first = np.concatenate(([0], np.cumsum(count)))
    long = np.flatnonzero(count >= LENGTH)
    place = np.repeat(np.arange(len(words)), count)
    found: list[list] = [[] for _ in words]
    if len(long):
        for start, end in survivors(ids, place):
            text = int(place[start])
            shift = start - int(first[text])
            found[text] += [(s + shift, n, q) for s, n, q in lag_scan(ids[start:end])]
    return [(w, sorted(r, key=lambda x: (x[0], x[2]))) for w, r in zip(words, found)]


def kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    stays = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(stays).tolist()])


RESULT = pa.struct(
    [
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("collapsed", pa.string()),
    ]
)


def collapse(spark: SparkSession, text: str | Column = "text") -> Column:
    """Column ``struct<n_words, runs: array<struct<start, length, period>>,
    collapsed>``: runs by start and period, and the text without their repeats."""
    ship.package(spark)

    @F.arrow_udf("struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, collapsed: string>")
    def collapsed(column: pa.Array) -> pa.Array:
        texts = arrays.texts_of(column)
        out = []
        for a, b in arrays.slices(texts):
            for words, runs in find(texts[a:b]):
                out.append((len(words), [dict(zip(("start", "length", "period"), r)) for r in runs], kept(words, runs).decode()))
        return pa.array([dict(zip(("n_words", "runs", "collapsed"), x)) for x in out], RESULT)

    return collapsed((F.col(text) if isinstance(text, str) else text).cast("binary"))


def tailed(words: list[bytes], h: int) -> list[bytes]:
    """Words whose tail repeats, as ``h`` tells where and how often."""
    n, g = len(words), h // 10
    if not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times = -(-(n - a) // p)
    return words[:a] + (words[a : a + p] * times)[: n - a]


def planted(text: str | Column = "text", doc_id: str | Column = "doc_id") -> Column:
    """The text, with a periodic tail where ``crc32(doc_id) % 10`` is 0 (words
    then joined by spaces); null ids get none."""

    @F.arrow_udf("string")
    def tail(column: pa.Array, hashes: pa.Array) -> pa.Array:
        pairs = zip(arrays.texts_of(column), hashes.to_pylist())
        return pa.array([None if h is None else b" ".join(tailed(x.split(), h)).decode() for x, h in pairs], pa.string())

    text, doc_id = (F.col(x) if isinstance(x, str) else x for x in (text, doc_id))
    h = F.crc32(doc_id.cast("string"))
    chosen = F.when(h % 10 == 0, h)
    return F.when(chosen.isNotNull(), tail(F.when(chosen.isNotNull(), text).cast("binary"), chosen)).otherwise(text)


def crc(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode())
