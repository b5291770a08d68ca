"""Operator 8, quality rules: n-gram perplexity with language-specific bands.

The language model is an interpolated modified Kneser-Ney model over runs of
``BYTES`` real bytes (case, marks and the bytes of every script count as they
are).  Spark counts the runs of all documents; the shorter orders down to
``LOWEST`` (continuation counts), the discounts and the weights of contexts
are grouped sums, so the model grows with the input and never passes through
the driver.  Below the lowest order stands a class model: runs of four symbols
of a fixed alphabet of 32 (letters without case, space, line end, digit,
sentence mark, other ASCII mark, byte beyond ASCII) times the share of the
byte in its symbol.  It only smooths what no order has seen; it has at most
32 ** 4 runs, which is what the driver collects and broadcasts.

As every text is part of the counts, each run is judged as if it occurred
once less: a run that occurs nowhere else falls to the shorter orders, so
noise does not vouch for itself.

Scoring: blocks of documents send their distinct runs to buckets of the
model, which is kept in the shared folder, and get the surprise of each,
rounded to ``1 / GRAIN`` (scores count in thousandths below).

A document's score is the mean negative logarithm per byte over its whole
text.  For each language (null is one of its own) the quartiles of the
scores, each text counting once, give the band: ``FENCE`` quartile ranges
(at least ``LEAST`` each) below the lower to above the upper quartile.  A
text outside its language's band is rejected; one without bytes has no
score and is not rejected for it.

:func:`rules` adds the counts of the base rules.  Null texts count as
empty; repeated rows are judged one by one; an empty table gives an empty
result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from followgraph.llm import arrays, scratch, ship

BYTES, LOWEST = 6, 4
ORDER = 4
BITS = 5
BLOCK_BYTES = 16 << 20
PIECE_BYTES = 512 << 10  # consecutive rows that are dealt together
GRAIN = 1024  # surprises are kept in steps of 1 / GRAIN
HELD = 1 << 22  # distinct runs that a task counts before it sends them
LEAST_CUT = 0.05
PRIME = 2**31 - 1  # runs are dealt to buckets by their remainder
FENCE = 3.0
LEAST = 0.03
WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20

# The symbols counted by the base rules.
SYMBOLS = b"#*$%&|<>"


def alphabet() -> np.ndarray:
    """The symbol of each byte."""
    out = np.full(256, 30, dtype=np.int32)
    out[128:] = 31
    for c in range(26):
        out[97 + c] = out[65 + c] = c
    out[[32, 9]] = 26
    out[[10, 11, 12, 13]] = 27
    out[48:58] = 28
    out[list(b".,;:?'-\"()")] = 29
    return out


ALPHABET = alphabet()
SIZE = 1 << BITS * ORDER


def codes(texts: list[bytes], order: int = ORDER, symbols: np.ndarray = ALPHABET, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """The run of ``order`` symbols that ends at each byte of each text (line
    ends stand before the first), and where each text's runs begin."""
    gap = b"\n" * (order - 1)
    symbol = symbols[np.frombuffer(gap + gap.join(texts), dtype=np.uint8)]
    n = len(symbol) - order + 1
    code = np.zeros(n, dtype=np.int32 if bits * order < 32 else np.int64)
    for j in range(order):
        code = (code << bits) | symbol[j : j + n]
    length = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begin = np.concatenate(([0], np.cumsum(length + order - 1)))[:-1]
    inside = np.zeros(n + 1, dtype=np.int32)
    np.add.at(inside, begin, 1)
    np.add.at(inside, np.minimum(begin + length, n), -1)
    return code[np.cumsum(inside[:n]) > 0], np.concatenate(([0], np.cumsum(length)))


def byte_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """:func:`codes` of runs of ``BYTES`` bytes, as they are."""
    return codes(texts, BYTES, np.arange(256), 8)


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``code, n``: how often each run of symbols occurs in all texts.  A task
    sends one row for each run it has met (at most 32 ** 4)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE, dtype=np.int64)
        for batch in batches:
            texts = arrays.texts_of(batch.column(0))
            for a, b in arrays.slices(texts):
                total += np.bincount(codes(texts[a:b])[0], minlength=SIZE)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], ["code", "n"])

    ship.package(docs.sparkSession)
    parts = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(run, "code long, n long")
    return parts.groupBy("code").agg(F.sum("n").alias("n"))


def hashed(code: np.ndarray, order: int) -> np.ndarray:
    return arrays.mix(code.astype(np.uint64) + (np.uint64(order) << np.uint64(40)))


def discounts(of: list[float]) -> list[float]:
    """Discounts of counts 1, 2 and from 3 on, by how many runs occur 1 to 4
    times; never zero, so that every context leaves some weight."""
    share = of[0] / (of[0] + 2 * of[1]) if of[0] else 0.5
    return [max(LEAST_CUT, min(c, c - (c + 1) * share * of[c] / of[c - 1])) if of[c - 1] else 0.5 for c in (1, 2, 3)]


class KneserNey:
    """Interpolated modified Kneser-Ney over codes of symbols.

    For each order, ``grams[k]`` has the sorted hashes of its runs and their
    discounted probabilities, ``contexts[k]`` those of the runs before the
    last symbol and the weight they leave to the next lower order.
    """

    def __init__(self, code: np.ndarray, n: np.ndarray):
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []
        self.contexts: list[tuple[np.ndarray, np.ndarray]] = []
        levels = [(code.astype(np.int64), n.astype(np.float64))]
        for order in range(ORDER - 1, 0, -1):
            # Continuation counts: how many different symbols stand before the shorter run.
            short, seen = np.unique(levels[-1][0] & ((1 << BITS * order) - 1), return_counts=True)
            levels.append((short, seen.astype(np.float64)))
        for order, (gram, count) in zip(range(1, ORDER + 1), reversed(levels), strict=True):
            cut = discounts([float((count == c).sum()) for c in (1, 2, 3, 4)])
            less = np.select([count == 1, count == 2], cut[:2], cut[2])
            context, at = np.unique(gram >> BITS, return_inverse=True)
            total = np.bincount(at, count, len(context))
            left = np.bincount(at, less, len(context)) / np.maximum(total, 1)
            self.grams.append(self._sorted(hashed(gram, order), (count - less) / total[at] if len(gram) else count))
            self.contexts.append(self._sorted(hashed(context, order), left))

    @staticmethod
    def _sorted(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(key)
        return key[order], value[order].astype(np.float64)

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], key: np.ndarray, default: float) -> np.ndarray:
        keys, values = table
        if not len(keys):
            return np.full(len(key), default)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, values[at], default)

    def probability(self, code: np.ndarray) -> np.ndarray:
        """Probability of the last symbol of each run after the others."""
        p = np.full(len(code), 1 / (1 << BITS))
        for order in range(1, ORDER + 1):
            short = code.astype(np.int64) & ((1 << BITS * order) - 1)
            own = self._find(self.grams[order - 1], hashed(short, order), 0.0)
            p = own + self._find(self.contexts[order - 1], hashed(short >> BITS, order), 1.0) * p
        return p


def model(docs: DataFrame, text: str = "text") -> KneserNey:
    """The class model of all texts of ``docs``."""
    rows = counted(docs, text).toArrow().sort_by("code")
    return KneserNey(rows.column("code").to_numpy(), rows.column("n").to_numpy())


def planes(x: np.ndarray, width: int) -> bytes:
    """Numbers of ``width`` bytes byte by byte, the highest bytes first, compressed."""
    data = x.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :].T.tobytes()
    return len(x).to_bytes(4, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unplaned(data: bytes, width: int) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, 8 - width :] = np.frombuffer(pa.decompress(data[4:], n * width, codec="zstd", asbytes=True), dtype=np.uint8).reshape(width, n).T
    return out.view(">u8").ravel().astype(np.int64)


def packed(code: np.ndarray) -> bytes:
    """Sorted codes, by their differences."""
    return planes(np.diff(code, prepend=0), BYTES)


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(unplaned(data, BYTES))


def dealt(code: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with places of sorted codes in it, in order."""
    bucket = code % PRIME % buckets
    order = np.argsort(bucket, kind="stable")
    met, first = np.unique(bucket[order], return_index=True)
    return zip(met.tolist(), np.split(order, first[1:]) if len(code) else [], strict=True)


def distinct(code: np.ndarray) -> np.ndarray:
    """The distinct codes, sorted (a sort is several times faster here than hashing)."""
    code = np.sort(code)
    return code[np.concatenate((np.ones(min(len(code), 1), dtype=bool), code[1:] != code[:-1]))]


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of all ``(codes, counts)`` with their summed counts."""
    code, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(code)
    code, n = code[order], n[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(len(code), 1), dtype=bool), code[1:] != code[:-1])))
    return code[first], np.add.reduceat(n, first) if len(first) else n


def blocks_of(docs: DataFrame, text: str = "text") -> int:
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("binary"))).alias("n")).first()["n"] or 0
    return max(1, -(-size // BLOCK_BYTES))


def byte_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``code, n``: how often each run of ``BYTES`` bytes occurs in all texts."""
    buckets = blocks_of(docs, text)

    def rows(code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        out = [(b, packed(code[x]), planes(n[x], 8)) for b, x in dealt(code, buckets)]
        columns = list(zip(*out, strict=True)) if out else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["bucket", "codes", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            texts = arrays.texts_of(batch.column(0))
            for a, b in arrays.slices(texts):
                held.append(np.unique(byte_codes(texts[a:b])[0], return_counts=True))
                if sum(len(k) for k, _ in held) > HELD:
                    held = [merged(held)]
                    if len(held[0][0]) > HELD // 2:
                        yield rows(*held.pop())
        if held:
            yield rows(*merged(held))

    def summed(table: pa.Table) -> pa.Table:
        parts = [(unpacked(c), unplaned(n, 8)) for c, n in zip(table.column("codes").to_pylist(), table.column("counts").to_pylist(), strict=True)]
        while len(parts) > 1:  # a few at a time, so that only distinct runs are held
            parts = [merged(parts[:8]), *parts[8:]]
        return pa.table([pa.array(x, pa.int64()) for x in parts[0]], names=["code", "n"])

    ship.package(docs.sparkSession)
    parts = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(run, "bucket int, codes binary, counts binary")
    return parts.groupBy("bucket").applyInArrow(summed, "code long, n long")


def class_base(fitted: KneserNey, share: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Probability of the last byte of each run of ``LOWEST`` bytes after the
    others: that of its symbol times its share in the symbol."""
    run = np.zeros(len(code), dtype=np.int64)
    for j in range(ORDER - 1, -1, -1):
        run = (run << BITS) | ALPHABET[(code >> (8 * j)) & 255]
    return fitted.probability(run) * share[code & 255]


def shares(counts: DataFrame) -> np.ndarray:
    """The share of each byte among those of its symbol, each counted once more."""
    seen = np.ones(256)
    for row in counts.groupBy((F.col("code").bitwiseAND(255)).alias("byte")).agg(F.sum("n").alias("n")).collect():  # 256 rows at most
        seen[row["byte"]] += row["n"]
    return seen / np.bincount(ALPHABET, seen, 1 << BITS)[ALPHABET]


def surprises(counts: DataFrame, fitted: KneserNey) -> DataFrame:
    """``code, surprise`` (in steps of ``1 / GRAIN``) of every run in ``counts``,
    as if it occurred once less.

    ``whole`` is the probability of a run with all counts, ``less`` with one
    occurrence taken away.  Where that was the only one, the run no longer
    counts for the next lower order either.
    """
    spark = counts.sparkSession
    levels = [counts]
    for order in range(BYTES - 1, LOWEST - 1, -1):
        # Continuation counts: how many different bytes stand before the shorter run.
        short = F.col("code").bitwiseAND((1 << 8 * order) - 1)
        levels.append(scratch.keep(levels[-1].groupBy(short.alias("code")).agg(F.count(F.lit(1)).alias("n")), "runs"))
    share = shares(counts)
    shared = spark.sparkContext.broadcast((fitted, share))

    @F.arrow_udf("double")
    def base(code: pa.Array) -> pa.Array:
        return pa.array(class_base(*shared.value, code.to_numpy(zero_copy_only=False)))

    lower = None
    for order, level in zip(range(LOWEST, BYTES + 1), reversed(levels), strict=True):
        of = level.agg(*[F.count_if(F.col("n") == c).alias(f"n{c}") for c in (1, 2, 3, 4)]).first()
        cut = discounts([float(x) for x in of])
        near = Window.partitionBy(F.shiftright("code", 8))
        met = [F.count_if(F.col("n") == c).over(near).alias(f"n{c}") for c in (1, 2)]
        rows = level.select("code", "n", F.sum("n").over(near).alias("total"), *met, F.count(F.lit(1)).over(near).alias("all"))
        rows = rows.withColumn("left", F.col("n1") * cut[0] + F.col("n2") * cut[1] + (F.col("all") - F.col("n1") - F.col("n2")) * cut[2])
        if lower is None:
            rows = rows.withColumn("whole", base("code")).withColumn("less", F.col("whole"))
        else:
            rows = rows.withColumn("short", F.col("code").bitwiseAND((1 << 8 * (order - 1)) - 1)).join(lower, "short")

        def discount(n: Column, cut: list[float] = cut) -> Column:
            return F.when(n <= 0, 0.0).when(n == 1, cut[0]).when(n == 2, cut[1]).otherwise(cut[2])

        n, total, left = F.col("n"), F.col("total"), F.col("left")
        whole = (n - discount(n)) / total + left / total * F.col("whole")
        rest = left - discount(n) + discount(n - 1)
        below = F.when(n == 1, F.col("less")).otherwise(F.col("whole"))
        less = F.when(total == 1, F.col("less")).otherwise((n - 1 - discount(n - 1)) / F.nullif(total - 1, F.lit(0)) + rest / F.nullif(total - 1, F.lit(0)) * below)
        lower = rows.select(F.col("code").alias("short"), whole.alias("whole"), less.alias("less"))
    return lower.select(F.col("short").alias("code"), F.round(-F.log("less") * GRAIN).cast("int").alias("surprise"))


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of each text."""
    words = arrays.Words(texts)
    n = len(texts)
    edges = np.append(words.text_start, len(words.buf))

    def per_text(mark: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mark)))
        return total[edges[1:]] - total[edges[:-1]]

    is_symbol = np.zeros(256, dtype=bool)
    is_symbol[list(SYMBOLS)] = True
    chars = arrays.IS_WORD[words.buf] & ((words.buf & 0xC0) != 0x80)
    value, at = arrays.grams(words.hashes(), words.text, WINDOW)
    order = np.lexsort((value, words.text[at]))
    same = (value[order][1:] == value[order][:-1]) & (words.text[at][order][1:] == words.text[at][order][:-1])
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    repeated = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) > 0)))
    lines = np.zeros(n, dtype=np.int64)
    for i, text in enumerate(texts):
        full = [x for x in text.split(b"\n") if x.strip(arrays.SEPARATORS)]
        lines[i] = len(full) - len(set(full))
    return {
        "n_words": np.diff(words.first),
        "word_chars": per_text(chars),
        "n_symbols": per_text(is_symbol[words.buf]),
        "n_dup_lines": lines,
        "n_repeat_words": repeated[words.first[1:]] - repeated[words.first[:-1]],
    }


def means(texts: list[bytes], code: np.ndarray, value: np.ndarray) -> list[float | None]:
    """The mean of the ``value`` of all runs of each text; ``code`` (sorted) has
    them all.  Runs are sorted with the number of their text in the low bits,
    so equal ones are looked up once."""
    out: list[float | None] = []
    for at in range(0, len(texts), 1 << 16):
        part = texts[at : at + (1 << 16)]
        runs, first = byte_codes(part)
        length = np.diff(first)
        pair = np.sort((runs.astype(np.uint64) << np.uint64(16)) | np.repeat(np.arange(len(part), dtype=np.uint64), length))
        run, text = (pair >> np.uint64(16)).astype(np.int64), (pair & np.uint64(0xFFFF)).astype(np.int64)
        new = np.flatnonzero(np.diff(run, prepend=-1))
        each = np.repeat(value[np.searchsorted(code, run[new])], np.diff(np.append(new, len(run))))
        total = np.bincount(text, each, len(part))
        out += [float(t / n) if n else None for t, n in zip(total.tolist(), length.tolist(), strict=True)]
    return out


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = "id {}, lang {}, " + ", ".join(f"{c} long" for c in COUNTS) + ", surprise double"
MESSAGE = "block int, bucket int, codes binary, surprise binary"


def _messages(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["block", "bucket", "codes", "surprise"])


def measures(docs: DataFrame, surprise: DataFrame) -> DataFrame:
    """``id, lang``, the base counts and the mean surprise of each row of
    ``docs`` (``id, lang, text``), by the ``code, surprise`` of all its runs."""
    ship.package(docs.sparkSession)
    blocks = blocks_of(docs)
    shards = surprise.withColumn("bucket", (F.col("code") % PRIME % blocks).cast("int"))
    kinds = dict(docs.dtypes)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b in arrays.slices(arrays.texts_of(batch.column("text")), PIECE_BYTES):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 4))) as to:
                    to.write_batch(batch.slice(a, b - a))
                out.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array([zlib.crc32(x) % blocks for x in out], pa.int32()), pa.array(out, pa.binary())], ["block", "piece"])

    def opened(table: pa.Table) -> pa.Table:
        return pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in table.column("piece").to_pylist()])

    def runs_of(texts: list[bytes]) -> np.ndarray:
        return distinct(np.concatenate([np.zeros(0, np.int64), *(distinct(byte_codes(texts[a:b])[0]) for a, b in arrays.slices(texts))]))

    def asked(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        code = runs_of(arrays.texts_of(opened(table).column("text")))
        return _messages([(block, b, packed(code[x]), None) for b, x in dealt(code, blocks)])

    def answered(table: pa.Table, shard: pa.Table) -> pa.Table:
        code, value = shard.column("code").to_numpy(), shard.column("surprise").to_numpy()
        order = np.argsort(code)
        code, value = code[order], value[order]
        out = []
        for block, bucket, data in zip(*(table.column(c).to_pylist() for c in ("block", "bucket", "codes")), strict=True):
            wanted = unpacked(data)
            at = np.searchsorted(code, wanted)
            if not len(code) or at[-1] >= len(code) or (code[at] != wanted).any():
                raise ValueError("the texts changed while they were read")
            out.append((block, bucket, None, planes(value[at], 4)))
        return _messages(out)

    def judged(table: pa.Table, replies: pa.Table) -> pa.Table:
        docs = opened(table)
        texts = arrays.texts_of(docs.column("text"))
        code = runs_of(texts)
        value = np.zeros(len(code))
        told = dict(zip(replies.column("bucket").to_pylist(), replies.column("surprise").to_pylist(), strict=True))
        for bucket, at in dealt(code, blocks):
            value[at] = unplaned(told[bucket], 4) / GRAIN  # fails if the texts changed while they were read
        parts: dict[str, list] = {c: [] for c in [*COUNTS, "surprise"]}
        for a, b in arrays.slices(texts):
            for name, values in base_counts(texts[a:b]).items():
                parts[name] += values.tolist()
            parts["surprise"] += means(texts[a:b], code, value)
        columns = [*(pa.array(parts[c], pa.int64()) for c in COUNTS), pa.array(parts["surprise"], pa.float64())]
        return pa.table([docs.column("id"), docs.column("lang"), *columns], names=["id", "lang", *COUNTS, "surprise"])

    rows = docs.withColumn("text", F.col("text").cast("binary")).mapInArrow(pieces, "block int, piece binary")
    asks = rows.groupBy("block").applyInArrow(asked, MESSAGE)
    replies = asks.groupBy("bucket").cogroup(shards.groupBy("bucket")).applyInArrow(answered, MESSAGE)
    return rows.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(judged, MEASURES.format(kinds["id"], kinds["lang"]))


def bands(scored: DataFrame) -> DataFrame:
    """``lang, low, high`` from ``lang, surprise``.  Scores count in bins of a
    thousandth, so a language is judged by a bounded table of bins."""
    bins = scored.where("surprise is not null").groupBy("lang", F.round("surprise", 3).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    quartiles = bins.groupBy("lang").agg(F.percentile("bin", F.lit(0.25), F.col("n")).alias("q1"), F.percentile("bin", F.lit(0.75), F.col("n")).alias("q3"))
    width = F.greatest(F.col("q3") - F.col("q1"), F.lit(LEAST)) * FENCE
    return quartiles.select("lang", (F.col("q1") - width).alias("low"), (F.col("q3") + width).alias("high"))


def rules(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``key``, the base counts, ``surprise``, ``base_failed`` and ``kept`` of every row."""
    rows = docs.select(F.col(key).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = scratch.keep(byte_counts(rows), "runs")
    measured = scratch.keep(measures(rows, scratch.keep(surprises(counts, model(rows)), "surprises")), "measures")
    band = bands(measured).withColumnRenamed("lang", "l")
    judged = measured.join(band, F.col("lang").eqNullSafe(F.col("l")), "left")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    normal = F.coalesce((F.col("surprise") >= F.col("low")) & (F.col("surprise") <= F.col("high")), F.lit(True))
    return judged.select(F.col("id").alias(key), *COUNTS, "surprise", failed.alias("base_failed"), (~failed & normal).alias("kept"))
