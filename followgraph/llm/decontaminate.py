"""Operator 1, benchmark decontamination: BM25 with block-max WAND.

The benchmark items are indexed; the training passages are the queries.  An
item's postings carry its BM25 impacts divided by the item's largest
possible score, so that a score is the share of the item, by weight, that a
passage holds, and one threshold suits all items.  Items are indexed by
length class: items of up to ``L`` words are sought in passages of ``2 * L``
words that start every ``L`` words, so any stretch as long as the item lies
whole in one of them, and passages cover every text to its end.  In how many
items a word occurs, their number and mean length are sums over all items,
so a score does not depend on the items that share a shard or a class.

1. Screen: an item's weakest terms, up to ``SLACK`` of the threshold by
   weight, are its common terms, the others its essential ones.  The
   essential impacts that a passage holds, plus all common ones of the item,
   bound the score from above; passages whose bound stays below the threshold for all items need
   no query.  The bounds of a batch are computed at once.
2. Query: block-max WAND over lists of postings in blocks with their largest
   impact, returning every item at or above the threshold.
3. Verification: an item leaks if at least ``OVERLAP`` of the five-word
   shingles of its question, and as much of its answer, occur in the
   passage.  (The answer is the last line, or the last sentence of a single
   line; a single sentence is both.)

Words are runs of letters and digits in lower case.  Null and empty texts
and items match nothing; an item without id is sought like any other and
reported with a null ``item_id``, before those with one.  Repeated items are
items of their own, all reported; an empty table leaks nothing.  The index goes to the workers in shards of at
most ``SHARD_WORDS`` words of items, each broadcast, so a broadcast is
bounded however large the benchmark is; the text of one item is never cut.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from followgraph.llm import arrays, scratch, ship

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
BLOCK = 64
SLACK = 0.7
SHARD_WORDS = 1_000_000
LEAKS = "array<struct<item_id:long,score:double,question_overlap:double,answer_overlap:double>>"


def term_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the texts, and each text's first word (one entry more)."""
    words = arrays.Words([(t or "").lower().encode() for t in texts], members=arrays.IS_ALNUM)
    return words.hashes(), words.first


def question_answer(text: str) -> tuple[str, str]:
    lines = [x for x in text.split("\n") if x.strip()]
    if len(lines) < 2:
        lines = [x for x in re.split(r"(?<=[.?!])\s+", text) if x.strip()]
    return ("\n".join(lines[:-1]), lines[-1]) if len(lines) > 1 else (text, text)


def shingles(words: list[int], size: int) -> set[tuple[int, ...]]:
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def overlap(part: list[int], passage: list[int]) -> float:
    """Share of the part's shingles in the passage; a part shorter than a
    shingle is one, and an empty part is there."""
    if not part:
        return 1.0
    size = min(SHINGLE, len(part))
    own = shingles(part, size)
    return len(own & shingles(passage, size)) / len(own)


class Statistics(NamedTuple):
    """Of all items with words: how many there are, their mean number of
    words, and how many have a term (for the terms of the items at hand)."""

    items: int
    mean: float
    df: dict[int, int]


class LengthClass:
    """Inverted index of the items of up to ``longest`` words."""

    def __init__(
        self, longest: int, items: list[tuple[int, list[int]]], parts: dict[int, tuple[list[int], list[int]]], threshold: float, of_all: Statistics
    ):
        self.longest, self.threshold, self.parts = longest, threshold, parts
        self.items = [item for item, _ in items]
        total, mean, df = of_all
        postings: dict[int, list[tuple[int, float]]] = {}
        hits: list[tuple[int, int, float]] = []
        need = []
        for number, (_, words) in enumerate(items):
            impact = {}
            for term, tf in Counter(words).items():
                idf = math.log(1 + (total - df[term] + 0.5) / (df[term] + 0.5))
                impact[term] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean))
            best = sum(impact.values())
            rest, essential = 0.0, []
            for term, x in sorted(impact.items(), key=lambda kv: (kv[1], kv[0])):
                postings.setdefault(term, []).append((number, x / best))
                if essential or rest + x / best > SLACK * threshold:
                    essential.append((term, number, x / best))
                else:
                    rest += x / best
            hits += essential
            need.append(threshold - rest)
        # Lists by item: item numbers, impacts, and the largest impact and last item of each block.
        self.lists = {}
        for term, pairs in postings.items():
            number, impact = [p[0] for p in pairs], [p[1] for p in pairs]
            blocks = range(0, len(pairs), BLOCK)
            self.lists[term] = (number, impact, max(impact), [max(impact[b : b + BLOCK]) for b in blocks], [number[b : b + BLOCK][-1] for b in blocks])
        # Essential postings by term, for the screen.
        hits.sort()
        self.term = np.array([h[0] for h in hits], dtype=np.uint64)
        self.number = np.array([h[1] for h in hits], dtype=np.int64)
        self.impact = np.array([h[2] for h in hits])
        self.distinct, self.head = np.unique(self.term, return_index=True)
        self.size = np.diff(np.append(self.head, len(hits)))
        self.need = np.array(need)

    def screen(self, hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
        """``(text, passage)`` whose bound reaches the threshold for some item."""
        place = np.searchsorted(self.distinct, hashes)
        place[place == len(self.distinct)] = 0
        at = np.flatnonzero(self.distinct[place] == hashes)
        if not len(at):
            return []
        text = np.searchsorted(first, at, side="right") - 1
        passage = (at - first[text]) // self.longest
        term = place[at]
        # A word lies in its own passage and in the one before; a term counts once in each.
        # (text, passage, term or item) fits one integer: passages are fewer than words.
        span = int(passage.max()) + 1
        code = (text * span + passage) * len(self.distinct) + term
        code = np.unique(np.concatenate([code, code[passage > 0] - len(self.distinct)]))
        place, term = np.divmod(code, len(self.distinct))
        size = self.size[term]
        posting = np.repeat(self.head[term] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        code = np.repeat(place, size) * len(self.need) + self.number[posting]
        code, back = np.unique(code, return_inverse=True)
        held = np.bincount(back, self.impact[posting], len(code))
        code = np.unique(code[held >= self.need[code % len(self.need)] - 1e-9] // len(self.need))
        return [(c // span, c % span) for c in code.tolist()]

    def query(self, words: list[int]) -> list[tuple[int, float]]:
        """Items at or above the threshold for a passage, by block-max WAND."""
        lists = [self.lists[t] for t in set(words) if t in self.lists]
        cursors = [[x[0][0], 0, i] for i, x in enumerate(lists)]  # next item, its place, the list
        out, limit = [], self.threshold - 1e-9
        while True:
            cursors.sort()
            bound, pivot = 0.0, -1
            for c, (_, _, i) in enumerate(cursors):
                bound += lists[i][2]
                if bound >= limit:
                    pivot = c
                    break
            if pivot < 0:
                return out
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            # Bound by the blocks that hold the pivot item.
            bound, stop = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else len(self.need)
            for c in cursors[: pivot + 1]:
                number, _, _, peak, last = lists[c[2]]
                block = c[1] // BLOCK
                while block < len(last) and last[block] < item:
                    block += 1
                if block < len(last):
                    bound += peak[block]
                    stop = min(stop, last[block] + 1)
            if bound < limit:
                target = max(stop, item + 1)  # nothing before it can reach the threshold
            elif cursors[0][0] == item:
                score = math.fsum(lists[i][1][at] for _, at, i in cursors[: pivot + 1])
                if score >= limit:
                    out.append((item, score))
                target = item + 1
            else:
                target = item
            moved = []
            for c, (now, at, i) in enumerate(cursors):
                number = lists[i][0]
                if c <= pivot and now < target:
                    while at < len(number) and number[at] < target:
                        block = at // BLOCK
                        at = (block + 1) * BLOCK if lists[i][4][block] < target else at + 1
                    if at >= len(number):
                        continue
                    now = number[at]
                moved.append([now, at, i])
            cursors = moved


class Index:
    """Length classes of one shard of items; ``of_all`` describes all shards
    (by default there is this one only)."""

    def __init__(self, items: list[tuple[int, str]], threshold: float = THRESHOLD, of_all: Statistics | None = None):
        hashes, first = term_hashes([t for _, t in items])
        classes: dict[int, list[tuple[int, list[int]]]] = {}
        parts: dict[int, tuple[list[int], list[int]]] = {}
        for n, (_, text) in enumerate(items):
            words = hashes[first[n] : first[n + 1]].tolist()
            if words:
                classes.setdefault(max(16, 1 << (len(words) - 1).bit_length()), []).append((n, words))
                h, f = term_hashes(list(question_answer(text)))
                parts[n] = (h[f[0] : f[1]].tolist(), h[f[1] : f[2]].tolist())
        if of_all is None:
            every = [words for rows in classes.values() for _, words in rows]
            mean = sum(map(len, every)) / max(1, len(every))
            of_all = Statistics(len(every), mean, Counter(t for words in every for t in set(words)))
        self.ids = [i for i, _ in items]
        self.classes = [LengthClass(longest, rows, parts, threshold, of_all) for longest, rows in sorted(classes.items())]

    def leaks(self, texts: list[str | None], share: float = OVERLAP) -> list[list[tuple[int, float, float, float]]]:
        """Items that each text holds: id, best score, overlap of question and answer."""
        hashes, first = term_hashes(texts)
        found: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
        for group in self.classes:
            for text, passage in group.screen(hashes, first):
                begin = first[text] + passage * group.longest
                words = hashes[begin : min(begin + 2 * group.longest, first[text + 1])].tolist()
                for number, score in group.query(words):
                    item = group.items[number]
                    question, answer = (overlap(part, words) for part in group.parts[item])
                    if question >= share and answer >= share:
                        found[text][item] = max(found[text].get(item, (0.0, 0.0, 0.0)), (score, question, answer))
        return [sorted(((self.ids[n], *x) for n, x in row.items()), key=lambda x: (x[0] is not None, x[0] or 0, *x[1:])) for row in found]


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``text, n, words`` (their number) and the distinct ``terms`` of texts."""
    for batch in batches:
        texts, n = (c.to_pylist() for c in batch.columns)
        for a, b in arrays.slices([t.encode() for t in texts]):
            hashes, first = term_hashes(texts[a:b])
            terms = [np.unique(hashes[x:y]).view(np.int64) for x, y in zip(first, first[1:], strict=False)]
            columns = [pa.array(texts[a:b], pa.string()), pa.array(n[a:b], pa.int64()), pa.array(np.diff(first), pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(terms, pa.list_(pa.int64()))], ["text", "n", "words", "terms"])


def described(items: DataFrame) -> tuple[DataFrame, int, float]:
    """``item_id, text, df`` of the items with words (``df`` maps their terms
    to the number of items that have them), the number of these items and the
    mean number of words, all counted in Spark over the whole benchmark."""
    ship.package(items.sparkSession)
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    texts = rows.groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    texts = scratch.keep(texts.mapInArrow(_terms, "text string, n long, words long, terms array<long>").where("words > 0"), "items")
    total = texts.agg(F.sum("n").alias("items"), F.sum(F.col("n") * F.col("words")).alias("words")).first()
    # Texts differ, so their digests stand for them while terms are counted and looked up.
    flat = texts.select(F.sha2("text", 256).alias("of"), "n", F.explode("terms").alias("term"))
    counts = flat.groupBy("term").agg(F.sum("n").alias("df"))
    known = flat.join(counts, "term").groupBy("of").agg(F.map_from_entries(F.collect_list(F.struct("term", "df"))).alias("df"))
    found = rows.withColumn("of", F.sha2("text", 256)).join(known, "of").select("item_id", "text", "df")
    many = int(total["items"] or 0)
    return found, many, int(total["words"] or 0) / max(1, many)


def shards(items: DataFrame) -> Iterator[tuple[list[tuple[int, str]], Statistics]]:
    """Items in order of their ids, at most ``SHARD_WORDS`` words at a time
    (one item at least), with the statistics of all."""
    rows, many, mean = described(items)
    held, df, size = [], {}, 0
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        n = len(row["text"].split())
        if held and size + n > SHARD_WORDS:
            yield held, Statistics(many, mean, df)
            held, df, size = [], {}, 0
        held.append((row["item_id"], row["text"]))
        df.update((term & (1 << 64) - 1, count) for term, count in row["df"].items())
        size += n
    if held:
        yield held, Statistics(many, mean, df)


def leaks(items: DataFrame, text: str = "text") -> Column:
    """Array column: the items of the benchmark (``item_id, text``) that a text holds."""
    spark = items.sparkSession
    ship.package(spark)

    def against(shard: list[tuple[int, str]], of_all: Statistics) -> Column:
        index = spark.sparkContext.broadcast(Index(shard, of_all=of_all))

        @F.arrow_udf(LEAKS)
        def found(column: pa.Array) -> pa.Array:
            texts = arrays.texts_of(column)
            names = ["item_id", "score", "question_overlap", "answer_overlap"]
            kind = pa.list_(pa.struct([(names[0], pa.int64()), *((n, pa.float64()) for n in names[1:])]))
            out = []
            for a, b in arrays.slices(texts):
                rows = index.value.leaks([t.decode(errors="replace") for t in texts[a:b]])
                out += [[dict(zip(names, x, strict=True)) for x in row] for row in rows]
            return pa.array(out, kind)

        return found(F.col(text).cast("binary"))

    columns = [against(*shard) for shard in shards(items)]
    if not columns:
        return F.array().cast(LEAKS)
    return columns[0] if len(columns) == 1 else F.concat(*columns)
