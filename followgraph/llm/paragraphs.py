"""Operator 6, substring dedup: paragraphs that repeat across documents.

Paragraphs are compared on words in lower case.  Besides lines, they are
chunks whose bounds depend on the content alone: a chunk begins where the hash
of three words is the least within ``REACH_CUT`` words, wherever lines end.  A
near copy inside a longer line or wrapped over short ones thus has chunks of
its own.  Paragraphs have ``LEAST`` words at least; shorter lines are compared
as parts of chunks, but not removed alone (a notice or heading is no passage).

* Near copies: of a set of ``n`` shingles (five words) the ``n - 0.8 n + 1``
  with the least hashes are kept (a bottom-k MinHash sketch).  Two sets at the
  threshold of 80 % share one of these at least, so no pair is left out.  Pairs
  whose sizes, places of the shared shingle or parities rule the threshold out
  are dropped; the others are verified on their full sets; links make
  components.  Shingles that a sample of texts shows to be frequent count as
  the largest hashes: this decides how many pairs are looked at, not which are
  found.
* Exact passages: windows of ``GRAM`` words, in every stretch of ``STRETCH``
  words the one with the smallest hash.  A passage of ``STRETCH`` words that
  two documents share thus has a window in common, at most ``REACH`` words
  from either end.  Windows in a row that lie in the same place of the same
  document make one run; only its two ends are compared word by word with the
  owner's text, so the whole passage goes, verified.

What a document with a smaller id has too is removed; of a chunk that is no
exact copy, what lies between the first and the last shingle it shares.  (Repeats inside one
document stay.)

Everything but texts travels as narrow rows: hashes and places of words, one
row for each window and paragraph, so that what is sent grows in proportion to
the input; hot hashes are combined before the shuffle or split by the join.  The
keys of many paragraphs that lie in one of ``SLICES`` travel in one row.
Texts are read once for the units, once where a place was asked for, and once
for the removal.

Null and empty texts have no paragraphs.  A null id counts as larger than
all others: such rows lose what a row with an id has, and remove nothing.
Rows that repeat an id do not remove from one another.  Texts of any length
are compared whole.  Other columns are not read.  An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from followgraph.llm import arrays, minhash, scratch, ship
from followgraph.llm.suffix_dedup import LAST, sliding

SHINGLE, THRESHOLD = 5, 80
BITS = 41  # of a shingle's hash; CLASS bits above them say how frequent it is
CLASS = 3
KEY = 6  # bytes of both
LEAD = 20  # of a hash's bits, by which most that are not frequent are told
SLICES = 4096  # of all keys; the entries that a batch has for one travel together
AT_ONCE = 4 << 20  # bytes of entries, of whole slices, that are paired together
SAMPLE, SEEN, FREQUENT = 64, 3, 1 << 15  # of so many texts one is looked at; frequent from so many on, and so many at most
FULL = 1023  # sizes from here on count as this
BUCKET, PER_UNIT = 4096, 8  # members, and pairs for each, up to which a bucket's pairs are listed
LEAST = 20
REACH_CUT, CUT_GRAM = 20, 3
STRETCH, GRAM = 50, 24
REACH = STRETCH - GRAM  # words between a shared passage's end and a window in it, at most


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[0], first[0] + 1, ...``, ``size[0]`` of them, then those of the next."""
    begin = np.cumsum(size) - size
    return np.repeat(first - begin, size) + np.arange(int(size.sum()))


Often = tuple[np.ndarray, np.ndarray]  # hashes of frequent shingles in order, and the class of each


def ordered(value: np.ndarray, often: Often | None) -> np.ndarray:
    """Hashes of shingles in ``CLASS + BITS`` bits, the frequent ones largest."""
    value = value >> np.uint64(64 - BITS)
    if often is None or not len(often[0]):
        return value
    known, kind = often
    # Few shingles agree with a frequent one in the leading bits; only these are looked up.
    lead = np.zeros(1 << LEAD, dtype=bool)
    lead[known >> np.uint64(BITS - LEAD)] = True
    some = np.flatnonzero(lead[value >> np.uint64(BITS - LEAD)])
    asked = value[some]
    place = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    value[some] = asked | (np.where(known[place] == asked, kind[place], 0).astype(np.uint64) << np.uint64(BITS))
    return value


UNITS_AT_ONCE = 1 << (64 - CLASS - BITS)


def sketches(gram: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of paragraphs with the shingles ``gram[first : last - SHINGLE + 1]``:
    size and parities of the sets, the number of least hashes, and these.

    A pair at the threshold has ``THRESHOLD`` percent of either set in common,
    so it cannot miss one set's ``n - THRESHOLD n / 100 + 1`` least altogether;
    the least common one is among those of both sets."""
    if not len(first):
        return np.zeros((0, 3), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    width = np.uint64(CLASS + BITS)
    size = last - first - SHINGLE + 1
    owner = np.repeat(np.arange(len(first), dtype=np.uint64), size)
    both = np.sort((owner << width) | gram[ranges(first, size)])
    both = both[np.diff(both, prepend=~both[0]) != 0]
    owner, value = (both >> width).astype(np.int64), both & np.uint64((1 << (CLASS + BITS)) - 1)
    n = np.bincount(owner, minlength=len(first))
    start = np.cumsum(n) - n
    spread = arrays.mix(value)
    bit = np.uint64(1) << (spread & np.uint64(63))
    odd = (spread >> np.uint64(6)) & np.uint64(1)
    parity = [np.bitwise_xor.reduceat(np.where(odd == half, bit, np.uint64(0)), start) for half in (0, 1)]
    many = n - (THRESHOLD * n + 99) // 100 + 1
    return np.stack([n.astype(np.uint64), *parity], axis=1), many, value[ranges(start, many)]


class Paragraphs:
    """Paragraphs and windows of a few texts: ``first, last`` (words, end
    exclusive), content hash ``unit`` and ``text``; the first ``len(sig)`` are
    paragraphs (``line`` tells lines from chunks), the rest windows.  ``sig`` has
    the size of a paragraph's shingle set and two parities of its halves, ``keys``
    (``n_keys`` of each) the least hashes; ``often`` are the frequent shingles."""

    def __init__(self, texts: list[bytes], often: Often | None = None):
        self.words = words = arrays.Words(texts, lower=True)
        hashes = words.hashes()
        n = len(hashes)
        base = arrays.powers(2)[1]
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        back = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 1), inverse)]))
        power = arrays.powers(n + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * back[:n])])

        def content(first: np.ndarray, last: np.ndarray) -> np.ndarray:
            return arrays.mix((sums[last] - sums[first]) * power[first] + (last - first).astype(np.uint64))

        # Lines: runs of words without a line feed between them.
        feeds = np.cumsum(words.buf == 10)
        line = feeds[words.start] if n else np.zeros(0, np.int64)
        begin = np.flatnonzero(np.diff(line, prepend=-1))
        bounds = [np.stack([begin, np.append(begin, n)[1:]])] if n else []
        # Chunks: from cut to cut, and the rests before the first and after the last cut of a text.
        begin = np.union1d(self._cuts(hashes), words.first[:-1][np.diff(words.first) > 0])
        bounds += [np.stack([begin, np.append(begin, n)[1:]])] if n else []
        both = np.concatenate(bounds, axis=1) if n else np.zeros((2, 0), np.int64)
        (first, last), source = np.unique(both, axis=1, return_index=True)
        long = last - first >= LEAST
        first, last, self.line = first[long], last[long], source[long] < (bounds[0].shape[1] if n else 0)
        value, at = arrays.grams(hashes, words.text, SHINGLE)
        gram = np.zeros(n, dtype=np.uint64)
        gram[at] = ordered(value, often)
        parts = [sketches(gram, first[i : i + UNITS_AT_ONCE], last[i : i + UNITS_AT_ONCE]) for i in range(0, max(len(first), 1), UNITS_AT_ONCE)]
        self.sig, self.n_keys, self.keys = (np.concatenate(x) for x in zip(*parts, strict=True))
        # Windows.
        head = np.zeros(0, dtype=np.int64)
        if n >= STRETCH:
            start = np.arange(n - GRAM + 1)
            order = content(start, start + GRAM) | np.uint64(1)
            low = sliding(np.minimum, order, STRETCH - GRAM + 1)
            low[words.text[: len(low)] != words.text[STRETCH - 1 :]] = 0
            edge = np.zeros(STRETCH - GRAM, dtype=np.uint64)
            best = sliding(np.maximum, np.concatenate([edge, low, edge]), STRETCH - GRAM + 1)
            head = np.flatnonzero(best == order)
        self.first = np.concatenate([first, head])
        self.last = np.concatenate([last, head + GRAM])
        self.text = words.text[self.first] if n else np.zeros(0, np.int64)
        self.unit = content(self.first, self.last)

    def _cuts(self, hashes: np.ndarray) -> np.ndarray:
        """Words where a chunk begins; only words of the same text decide."""
        words = self.words
        value, at = arrays.grams(hashes, words.text, CUT_GRAM)
        most = np.uint64(0xFFFFFFFFFFFFFFFF)
        place = at + (words.text[at] + 1) * REACH_CUT
        x = np.full(len(hashes) + (len(words.first) + 1) * REACH_CUT, most)
        x[place] = value
        if len(x) < 2 * REACH_CUT + 1:
            return np.zeros(0, np.int64)
        low = sliding(np.minimum, x, REACH_CUT)  # low[i]: the least of x[i : i + REACH_CUT]
        return at[(value < low[place - REACH_CUT]) & (value <= low[np.minimum(place + 1, len(low) - 1)])]


UNITS = "doc long, th long, first int, last int, unit long, line boolean, n int, even long, odd long, keys binary"


def units_of(rows: DataFrame, often: Often) -> DataFrame:
    """Paragraphs and windows (``keys`` null) of all ``rows`` (``doc, th, text``)."""
    names = [c.split()[0] for c in UNITS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, th = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "th"))
            for a, b in arrays.slices(texts := arrays.texts_of(batch.column("text"))):
                found = Paragraphs(texts[a:b], often)
                text, begin = found.text, found.words.first[found.text]
                rest = len(text) - len(found.sig)
                offsets = np.concatenate([[0], np.cumsum(found.n_keys), np.full(rest, len(found.keys))]).astype(np.int32) * KEY
                body = found.keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY].tobytes()
                window = np.arange(len(text)) >= len(found.sig)
                valid = np.packbits(~window, bitorder="little")
                keys = pa.Array.from_buffers(pa.binary(), len(text), [pa.py_buffer(valid.tobytes()), pa.py_buffer(offsets.tobytes()), pa.py_buffer(body)])
                numbers = [doc[a + text], th[a + text], (found.first - begin).astype(np.int32), (found.last - begin).astype(np.int32), found.unit.view(np.int64)]
                line = np.concatenate([found.line, np.zeros(rest, dtype=bool)])
                sig = np.concatenate([found.sig.astype(np.uint64).view(np.int64), np.zeros((rest, 3), np.int64)])
                sig = [pa.array(np.ascontiguousarray(c), mask=window) for c in (sig[:, 0].astype(np.int32), sig[:, 1], sig[:, 2])]
                yield pa.RecordBatch.from_arrays([*map(pa.array, numbers), pa.array(line), *sig, keys], names)

    return rows.select("doc", "th", "text").mapInArrow(run, UNITS)


def frequent(rows: DataFrame) -> Often:
    """The shingles that most texts of a sample have, at most ``FREQUENT``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in arrays.slices(texts := arrays.texts_of(batch.column("text"))):
                words = arrays.Words(texts[a:b], lower=True)
                value, at = arrays.grams(words.hashes(), words.text, SHINGLE)
                pairs = np.unique(np.stack([words.text[at].astype(np.uint64), ordered(value, None)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[1].view(np.int64))], ["value"])

    some = rows.where(F.pmod("th", F.lit(SAMPLE)) == 0).dropDuplicates(["th"]).select("text")
    counts = some.mapInArrow(run, "value long").groupBy("value").count().where(F.col("count") >= SEEN)
    top = counts.orderBy(F.desc("count"), "value").limit(FREQUENT).collect()
    value, count = (np.array([r[i] for r in top], dtype=np.int64) for i in (0, 1))
    order = np.argsort(value)
    kind = np.minimum(np.log2(np.maximum(count, 1) / SEEN).astype(np.int64) + 1, (1 << CLASS) - 1)
    return value[order].astype(np.uint64), kind[order]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words asked for, in lower case, one space apart."""
    names = ["doc", "th", "first", "last", "unit", "words", "after"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        out: list[tuple] = []
        for doc, th, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = text.lower().split()  # bytes: A-Z only, at the six separators
            for first, last, unit in ((p["first"], p["last"], p["unit"]) for p in places):
                if unit is not None:
                    out.append((None, None, None, None, unit, b" ".join(words[first:last]), None))
                else:
                    before = b" ".join(words[max(0, first - REACH) : first + GRAM])
                    out.append((doc, th, first, last, None, before, b" ".join(words[last : last + REACH])))
            if len(out) > 20_000:
                yield flush(out)
                out = []
        yield flush(out)


FETCHED = "doc long, th long, first int, last int, unit long, words binary, after binary"


def fetched(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """Words of the places ``asked`` for (``doc, th, first, last, unit``): of
    paragraphs the whole, by ``unit``; of runs (null) the first window with
    ``REACH`` words before it, and what follows (``after``)."""
    lists = asked.groupBy("doc", "th").agg(F.collect_set(F.struct("first", "last", "unit")).alias("places"))
    found = rows.select("doc", "th", "text").join(lists, ["doc", "th"]).dropDuplicates(["doc", "th"]).select("doc", "th", "text", "places")
    return found.mapInArrow(_texts, FETCHED)


def runs_of(windows: DataFrame) -> DataFrame:
    """``doc, th, first, last, odoc, oth, ofirst, olast``: runs of windows of a
    document that lie, in the same distances, in one with a smaller id."""
    ends = windows.groupBy("unit").agg(F.min("doc").alias("odoc"), F.max("doc").alias("last_doc")).where("odoc <> last_doc")
    hits = scratch.keep(windows.select("unit", "doc", "th", "first").join(ends.drop("last_doc"), "unit"), "windows")
    owners = hits.where("doc = odoc").groupBy("unit").agg(F.min(F.struct("th", "first")).alias("o"))
    owners = owners.select("unit", F.col("o.th").alias("oth"), F.col("o.first").alias("ofirst"))
    members = hits.where("doc <> odoc").join(owners, "unit").select("doc", "th", "first", "odoc", "oth", "ofirst").distinct()
    by_doc = Window.partitionBy("doc", "th").orderBy("first")
    shift = F.col("first") - F.col("ofirst")
    same = (
        (F.lag("odoc").over(by_doc) == F.col("odoc"))
        & (F.lag("oth").over(by_doc) == F.col("oth"))
        & (F.lag("shift").over(by_doc) == F.col("shift"))
        & (F.col("first") - F.lag("first").over(by_doc) <= GRAM)
    )
    broken = members.withColumn("shift", shift).withColumn("new", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1))
    numbered = broken.withColumn("run", F.sum("new").over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    runs = numbered.groupBy("doc", "th", "run", "odoc", "oth").agg(
        F.min("first").alias("first"), (F.max("first") + GRAM).alias("last"), F.min("ofirst").alias("ofirst"), (F.max("ofirst") + GRAM).alias("olast")
    )
    found = scratch.keep(runs.drop("run"), "runs")
    scratch.forget(hits)
    return found


def _within(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether two entries of a bucket (size and rank of the key in the low bits)
    may be at the threshold with the key their least common shingle: all
    smaller ones of both then are not in common."""
    n, m, i, j = (p >> 10) & FULL, (q >> 10) & FULL, p & 1023, q & 1023
    near = 100 * np.minimum(n, m) >= THRESHOLD * np.maximum(n, m)
    return near & ((i + j <= (n + m) * (100 - THRESHOLD) // (100 + THRESHOLD)) | (n == FULL) | (m == FULL))


def _pairs_of(packed: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of whole buckets: pairs that may be at the threshold (``a < b``), the
    bucket's key, and whether they are a bucket's listed pairs.  Of a bucket with
    too many, each member is returned with the smallest, itself too."""
    key = packed >> 20
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.append(start, len(key)))
    out: list[tuple] = []
    for c in np.unique(count[(count > 1) & (count <= 2 * PER_UNIT)]):
        i, j = np.triu_indices(c, 1)
        begin = start[count == c]
        step = max(1, (1 << 21) // len(i))
        for x in range(0, len(begin), step):
            p, q = ((begin[x : x + step, None] + k).ravel() for k in (i, j))
            ok = _within(packed[p], packed[q])
            out.append((p[ok], q[ok], True))
    for begin, c in zip(start[count > 2 * PER_UNIT].tolist(), count[count > 2 * PER_UNIT].tolist(), strict=True):
        listed: list[tuple] = []
        many = 0
        if c <= BUCKET:
            for x in range(0, c, 256):
                rows = np.arange(begin + x, begin + min(x + 256, c))
                i, j = np.nonzero(np.triu(_within(packed[rows][:, None], packed[begin + x : begin + c][None, :]), 1))
                listed.append((rows[i], begin + x + j, True))
                many += len(i)
                if many > PER_UNIT * c:
                    break
        if c > BUCKET or many > PER_UNIT * c:
            every = np.arange(begin, begin + c)
            listed = [(np.full(c, begin + int(np.argmin(unit[every]))), every, False)]
        out += listed
    p, q = (np.concatenate([np.zeros(0, np.int64), *(o[k] for o in out)]) for k in (0, 1))
    listed = np.concatenate([np.zeros(0, bool), *(np.full(len(o[0]), o[2]) for o in out)])
    return np.minimum(unit[p], unit[q]), np.maximum(unit[p], unit[q]), key[p], listed


ENTRIES = "slice int, entries binary"


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of paragraphs (``unit, n, keys``) as entries (key, size and rank
    in one number, and the unit), those of one slice in one row."""
    for batch in batches:
        units, sizes = (batch.column(c).to_numpy() for c in ("unit", "n"))
        for a, b in arrays.slices(lists := batch.column("keys").to_pylist()):
            many = np.fromiter(map(len, lists[a:b]), dtype=np.int64, count=b - a) // KEY
            wide = np.zeros((int(many.sum()), 8), dtype=np.uint8)
            wide[:, :KEY] = np.frombuffer(b"".join(lists[a:b]), dtype=np.uint8).reshape(-1, KEY)
            key, n = wide.view("<i8").ravel(), np.repeat(np.minimum(sizes[a:b], FULL).astype(np.int64), many)
            rank = np.where(n < FULL, ranges(np.zeros(b - a, np.int64), many), 0)
            entries = np.stack([(key << 20) | (n << 10) | rank, np.repeat(units[a:b], many)], axis=1)
            part = (arrays.mix(key.view(np.uint64)) % np.uint64(SLICES)).astype(np.int16)
            count = np.bincount(part, minlength=SLICES)
            used = np.flatnonzero(count)
            offsets = np.concatenate([[0], np.cumsum(count[used])]).astype(np.int32) * 16
            body = entries[np.argsort(part, kind="stable")].astype("<i8").tobytes()
            blobs = pa.Array.from_buffers(pa.binary(), len(used), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(body)])
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), blobs], ["slice", "entries"])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of entries that come ordered, slice by slice."""

    def found(lists: list[bytes]) -> pa.RecordBatch:
        entries = np.frombuffer(b"".join(lists), dtype="<i8").reshape(-1, 2)
        packed, unit = entries[np.argsort(entries[:, 0])].T
        a, b, key, listed = _pairs_of(packed, unit)
        # A pair that shares several keys here is needed once.
        mark = np.where(listed, 0, key)
        order = np.lexsort((listed, mark, b, a))
        same = [x[order][1:] == x[order][:-1] for x in (a, b, mark, listed)]
        once = order[np.concatenate([[True], ~np.logical_and.reduce(same)])[: len(order)]]
        return pa.RecordBatch.from_arrays([pa.array(a[once]), pa.array(b[once]), pa.array(key[once], mask=listed[once])], ["a", "b", "key"])

    held: list[bytes] = []
    last, size = None, 0
    for batch in batches:
        for part, entries in zip(batch.column("slice").to_pylist(), batch.column("entries").to_pylist(), strict=True):
            if part != last and size >= AT_ONCE:
                yield found(held)
                held, size = [], 0
            held.append(entries)
            last, size = part, size + len(entries)
    if held:
        yield found(held)


def components_of(paragraphs: DataFrame, rows: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``node, component`` of the paragraphs that are near copies of others, and
    the texts of these and of the runs ``asked`` for."""
    one = paragraphs.groupBy("unit").agg(F.first("n").alias("n"), F.first("keys").alias("keys"))
    entries = one.select("unit", "n", "keys").mapInArrow(_entries, ENTRIES)
    dealt = entries.repartition("slice").sortWithinPartitions("slice")
    met = scratch.keep(dealt.mapInArrow(_candidates, "a long, b long, key long"), "met")

    pairs = met.where("key is null").select("a", "b").distinct()
    hits = met.where("key is not null").select("key", F.col("a").alias("pivot"), F.col("b").alias("doc"))
    ends = met.select(F.explode(F.array("a", "b")).alias("unit")).distinct()
    first = paragraphs.join(ends, "unit", "left_semi").groupBy("unit").agg(F.min(F.struct("doc", "th", "first", "last", "n", "even", "odd")).alias("p"))
    first = scratch.keep(first.select("unit", "p.*"), "met-units")
    a, b = (first.select([F.col(c).alias(x + c) for c in ("unit", "n", "even", "odd")]) for x in "ab")
    differ = F.bit_count(F.col("aeven").bitwiseXOR(F.col("beven"))) + F.bit_count(F.col("aodd").bitwiseXOR(F.col("bodd")))
    both = F.col("an") + F.col("bn")
    likely = (differ * (100 + THRESHOLD) <= both * (100 - THRESHOLD)) & (100 * F.least("an", "bn") >= THRESHOLD * F.greatest("an", "bn"))
    pairs = scratch.keep(pairs.withColumnRenamed("a", "aunit").join(a, "aunit").withColumnRenamed("b", "bunit").join(b, "bunit").where(likely).select(F.col("aunit").alias("a"), F.col("bunit").alias("b")), "near-pairs")

    near = pairs.select(F.explode(F.array("a", "b")).alias("unit")).unionByName(hits.select(F.col("doc").alias("unit"))).distinct()
    near = first.join(near, "unit", "left_semi").select("doc", "th", "first", "last", "unit")
    texts = scratch.keep(fetched(rows, asked.unionByName(near)), "texts")
    scratch.forget(first)
    own = texts.where("unit is not null").select(F.col("unit").alias("doc_id"), F.col("words").alias("text"))
    groups = scratch.keep(minhash.settled(hits, own, SHINGLE, THRESHOLD, also=pairs), "groups")
    scratch.forget(met, pairs)
    return groups, texts


def agreement(own: list[bytes], first: int, last: int, before: list[bytes], after: list[bytes]) -> tuple[int, int] | None:
    """How far the run ``own[first:last]`` reaches in the words of its text.
    ``before`` ends with the run's first ``GRAM`` words in the owner's text,
    ``after`` is what follows the run there; none if the words differ."""
    if own[first : first + GRAM] != before[-GRAM:]:
        return None
    most = len(before) - GRAM
    if most <= first and own[first - most : first] == before[:most]:
        first -= most
    else:
        for word in reversed(before[:most]):
            if first == 0 or own[first - 1] != word:
                break
            first -= 1
    if own[last : last + len(after)] == after:
        return first, last + len(after)
    for word in after:
        if last == len(own) or own[last] != word:
            break
        last += 1
    return first, last


def trimmed(own: list[bytes], first: int, last: int, other: list[bytes]) -> tuple[int, int]:
    """The chunk ``own[first:last]`` without what stands before and after the
    shingles that the chunk ``other`` has too (whole, if there are none)."""
    known = {tuple(other[i : i + SHINGLE]) for i in range(len(other) - SHINGLE + 1)}
    places = range(first, last - SHINGLE + 1)
    begin = next((i for i in places if tuple(own[i : i + SHINGLE]) in known), None)
    if begin is None:
        return first, last
    return begin, next(i for i in reversed(places) if tuple(own[i : i + SHINGLE]) in known) + SHINGLE


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, counts = (batch.column(c).to_pylist() for c in ("doc_id", "text", "n_shared"))
        size = batch.column("places").value_lengths().fill_null(0).to_numpy()
        end = np.cumsum(size)
        flat = batch.column("places").flatten()
        firsts, lasts, owner, before, after, other = (c.to_pylist() for c in flat.flatten())
        out: list[tuple] = []
        for doc_id, text, count, a, b in zip(ids, texts, counts, (end - size).tolist(), end.tolist(), strict=True):
            if a == b:
                out.append((doc_id, count, [], [], text))
                continue
            own = text.lower().split()
            marks, owners = bytearray(len(own)), set()
            # Passages first; a paragraph that has nothing left then has no owner of its own.
            for p in sorted(range(a, b), key=lambda p: (before[p] is None, owner[p])):
                place = firsts[p], lasts[p]
                if before[p] is not None:
                    # A passage ends at most REACH words from its run: all of these may be gone.
                    if marks.find(0, max(0, place[0] - REACH), place[1] + REACH) < 0:
                        continue
                    place = agreement(own, *place, before[p].split(), after[p].split())
                elif other[p] is not None and marks.find(0, *place) >= 0:
                    place = trimmed(own, *place, other[p].split())
                if place and marks.find(0, *place) >= 0:
                    marks[place[0] : place[1]] = b"\1" * (place[1] - place[0])
                    owners.add(owner[p])
            gone = np.frombuffer(marks, dtype=bool)
            inside = np.concatenate([[False], arrays.IS_WORD[np.frombuffer(text, dtype=np.uint8)], [False]])
            start, stop = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2).T
            first, last = np.flatnonzero(np.diff(gone, prepend=False, append=False)).reshape(-1, 2).T
            spans = list(zip(start[first].tolist(), stop[last - 1].tolist(), strict=True))
            cuts = [0, *(x for s in spans for x in s), len(text)]
            left = b"".join(text[a:b] for a, b in zip(cuts[0::2], cuts[1::2], strict=True))
            out.append((doc_id, count, sorted(owners), [{"start": a, "end": b} for a, b in spans], left))
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), span, pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n_shared", "owners", "spans", "kept"])


def kept(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, spans`` (byte ranges removed), ``owners`` (the documents that
    keep what was removed here), ``n_shared`` (paragraphs and passages that
    other documents have as well) and ``kept`` (the rest of the text) of every row."""
    ship.package(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
    rows = rows.select("doc_id", F.coalesce("doc_id", F.lit(int(LAST))).alias("doc"), F.xxhash64("text").alias("th"), "text")
    units = scratch.keep(units_of(rows, frequent(rows)), "paragraphs")
    paragraphs = units.where("keys is not null")
    runs = runs_of(units.where("keys is null").select("doc", "th", "first", "last", "unit"))

    lent = runs.select(F.col("odoc").alias("doc"), F.col("oth").alias("th"), F.col("ofirst").alias("first"), F.col("olast").alias("last"))
    groups, texts = components_of(paragraphs, rows, lent.withColumn("unit", F.lit(None).cast("long")))
    # What several documents have is told by content first: only that is looked up in the paragraphs.
    several = paragraphs.groupBy("unit").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    several = several.join(groups, F.col("unit") == groups.node, "left").where("component is not null or low <> high")
    several = scratch.keep(several.select("unit", "low", "high", F.coalesce("component", "unit").alias("component")), "several")
    owner = several.groupBy("component").agg(F.min("low").alias("owner"), F.max("high").alias("last_doc")).where("owner <> last_doc")
    owned = several.select("unit", "component").join(owner.drop("last_doc"), "component")
    whole = scratch.keep(paragraphs.select("doc", "th", "first", "last", "unit", "line").join(owned, "unit"), "whole")
    scratch.forget(units, several)
    # A chunk that is not equal to its owner's is cut to what they share.
    of_owner = whole.where("doc = owner").groupBy("component").agg(F.min("unit").alias("kept_unit"))
    near = of_owner.join(groups.select(F.col("component").alias("c")).distinct(), F.col("component") == F.col("c"), "left_semi")
    own = texts.where("unit is not null").select(F.col("unit").alias("kept_unit"), F.col("words").alias("other"))
    near = scratch.keep(near.select("component", "kept_unit"), "owners").join(own, "kept_unit").select("component", "kept_unit", "other")
    other = F.when(~F.col("line") & (F.col("unit") != F.col("kept_unit")), F.col("other"))
    none = F.lit(None).cast("binary")
    removed = whole.join(near, "component", "left").select("doc", "th", "first", "last", "owner", none.alias("before"), none.alias("after"), other.alias("other"))

    ends = texts.where("unit is null").select(
        F.col("doc").alias("odoc"), F.col("th").alias("oth"), F.col("first").alias("ofirst"), F.col("last").alias("olast"), F.col("words").alias("before"), "after"
    )
    passages = runs.join(ends, ["odoc", "oth", "ofirst", "olast"])
    passages = passages.select("doc", "th", "first", "last", F.col("odoc").alias("owner"), "before", "after", none.alias("other"))
    lent = lent.withColumns({"owner": F.col("doc"), "before": none, "after": none, "other": none})
    spans = F.struct("first", "last", "owner", "before", "after", "other")
    places = scratch.keep(removed.unionByName(passages).unionByName(lent), "places")
    scratch.forget(whole, groups, texts, runs)
    of_doc = places.groupBy("doc", "th").agg(F.collect_set(spans).alias("places"))
    judged = rows.join(of_doc, ["doc", "th"], "left").select(
        "doc_id", "text", F.size(F.coalesce("places", F.array())).cast("long").alias("n_shared"), F.filter("places", lambda p: p["owner"] < F.col("doc")).alias("places")
    )
    return judged.mapInArrow(_removed, "doc_id long, n_shared long, owners array<long>, spans array<struct<start: long, end: long>>, kept binary")
