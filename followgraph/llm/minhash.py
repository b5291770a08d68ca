"""Operator 5, near-duplicate documents: MinHash, banding, verification, components.

1. Each document's shingles (distinct runs of ``k`` words, lower-cased
   A-Z) get ``BANDS * ROWS`` minima under multiply-add hashes.  With 26
   bands of 5 rows, a pair at the similarity asked for meets in at least
   one band but for about 4 in ten million pairs at 85 %.
2. Documents with equal shingle sets (by a 128-bit digest of the whole set)
   are one class, represented by its smallest id.  However many copies
   there are, only the class goes on.
3. In each bucket of a band, every class is paired with the bucket's
   smallest; a pair becomes a link if the full shingle sets agree enough.
4. Members that are not linked with their bucket's smallest are paired once
   more, with the member of the bucket that has most links.
5. Components of the links.  Where a bucket still touches more than one,
   the members of all such buckets with the same smallest make a cluster, in
   which those outside the largest component are compared with all others,
   tile by tile on the full sets.  Pairs inside a component cannot change the
   result, and a task returns only as many links as join its components,
   never all pairs.
6. Components of all links.

Texts without words are linked with nothing.  A null ``doc_id`` is linked
with nothing and is its own group (``component_id`` null, ``kept`` true).
Rows that repeat a ``doc_id`` are one document, linked by whatever any of
its texts is linked with.  An empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from followgraph.llm import arrays, scratch, ship
from followgraph.llm.components import components

BANDS, ROWS = 26, 5
TILE = 1024
FAN = 256  # partners that share one copy of a pivot's text
SEED = 11


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = arrays.Words(texts, lower=True)
    hashes = words.hashes()
    value, at = arrays.grams(hashes, words.text, k)
    first = np.searchsorted(words.text[at], np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        a, b = words.first[i], words.first[i + 1]
        if b - a >= k:
            out.append(np.unique(value[first[i] : first[i + 1]]))
        elif b > a:  # fewer words than a shingle has: all of them are one
            whole, _ = arrays.grams(hashes[a:b], words.text[a:b], int(b - a))
            out.append(whole ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def minima(values: np.ndarray, starts: np.ndarray, many: int) -> np.ndarray:
    """``many`` hash minima (high 32 bits) of each set; ``values`` has the sets
    one after another, from ``starts`` on, none of them empty."""
    rng = np.random.default_rng(SEED)
    factor = rng.integers(0, 1 << 63, many, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 1 << 63, many, dtype=np.uint64)
    out = np.empty((len(starts), many), dtype="<u4")
    hashed = np.empty_like(values)
    for j in range(many):
        np.multiply(values, factor[j], out=hashed)
        hashed += shift[j]
        out[:, j] = np.minimum.reduceat(hashed, starts) >> np.uint64(32)
    return out


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, n_shingles, digest, sig`` of each row (the last two null without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = arrays.texts_of(batch.column(1))
            size, digest, sig = [], [], []
            for a, b in arrays.slices(texts, 1 << 20):
                sets = shingle_sets(texts[a:b], k)
                size += [len(s) for s in sets]
                full = [s for s in sets if len(s)]
                starts = np.cumsum([0, *map(len, full)])[:-1]
                rows = iter(minima(np.concatenate(full), starts, BANDS * ROWS) if full else ())
                digest += [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                sig += [next(rows).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())],
                ["doc_id", "n_shingles", "digest", "sig"],
            )

    ship.package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, digest binary, sig binary")


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of complete groups from batches in which the rows of a group are adjacent."""
    rest: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        key = list(zip(*(part.column(k).to_pylist() for k in keys), strict=True))
        cut = len(key)
        while cut > 0 and key[cut - 1] == key[-1]:
            cut -= 1
        before = None
        if rest:
            before = tuple(rest[-1].column(k)[-1].as_py() for k in keys)
        if cut == 0 and before == key[0]:
            rest.append(part)
            continue
        if cut == 0:
            yield pa.concat_tables(rest) if rest else part.slice(0, 0)
        else:
            yield pa.concat_tables([*rest, part.slice(0, cut)])
        rest = [part.slice(cut)]
    if rest:
        yield pa.concat_tables(rest)


def agreeing(firsts: list[list[np.ndarray]], seconds: list[tuple[int, np.ndarray]], threshold: int) -> np.ndarray:
    """Which of ``seconds`` (group, shingles) have a similarity of ``threshold``
    with one of the sets that ``firsts`` has for their group."""
    out = np.zeros(len(seconds), dtype=bool)
    group = np.array([g for g, _ in seconds], dtype=np.int64)
    size = np.array([len(values) for _, values in seconds], dtype=np.int64)
    mark = arrays.mix(np.arange(1, len(firsts) + 1, dtype=np.uint64))  # keeps the groups' shingles apart
    for j in range(max(map(len, firsts), default=0)):
        chosen = [sets[j] if len(sets) > j else np.zeros(0, dtype=np.uint64) for sets in firsts]
        have = np.array([len(values) for values in chosen])
        open_ = np.flatnonzero(~out & (size > 0) & (have[group] > 0))
        if not len(open_):
            continue
        known = np.sort(np.concatenate(chosen) ^ np.repeat(mark, have))
        asked = np.concatenate([seconds[i][1] for i in open_]) ^ np.repeat(mark[group[open_]], size[open_])
        hit = known[np.minimum(np.searchsorted(known, asked), len(known) - 1)] == asked
        shared = np.add.reduceat(hit, np.cumsum(size[open_]) - size[open_], dtype=np.int64)
        out[open_] = (shared > 0) & (100 * shared >= threshold * (have[group[open_]] + size[open_] - shared))
    return out


def verified(pairs: DataFrame, docs: DataFrame, k: int, threshold: int) -> DataFrame:
    """Those of ``pairs`` (``a, b``, distinct) whose full shingle sets have
    100 * intersection >= threshold * union.

    A text is fetched once for each pair it is the second of, and once for
    each ``FAN`` pairs it is the first of, so that a document with many
    partners is spread over tasks.  A task holds one first text at a time.
    What is asked for is written first, so that its size is known to the join:
    few pairs then need no shuffle of all texts.
    """
    fan = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(FAN)).cast("int").alias("n"))
    second = pairs.join(fan, "a").select("a", F.expr("cast(pmod(xxhash64(b), n) as int)").alias("salt"), F.lit(1).alias("role"), F.col("b").alias("id"))
    first = fan.select("a", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("salt"), F.lit(0).alias("role"), F.col("a").alias("id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    asked = scratch.keep(first.unionByName(second), "asked")
    rows = asked.join(texts, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, own = None, []  # the first document, and the sets of its texts
        for batch in batches:
            a, salt, role, b, texts = (batch.column(i).to_pylist() for i in range(5))
            out = []
            for x, y in arrays.slices([t or b"" for t in texts], 1 << 20):
                firsts, seconds, rows = [own], [], []
                for i, values in enumerate(shingle_sets([t or b"" for t in texts[x:y]], k), x):
                    if role[i] == 0:
                        if held != (a[i], salt[i]):
                            held, own = (a[i], salt[i]), []
                            firsts.append(own)
                        own.append(values)
                    else:
                        seconds.append((len(firsts) - 1, values))
                        rows.append(i)
                out += [(a[rows[j]], b[rows[j]]) for j in np.flatnonzero(agreeing(firsts, seconds, threshold)).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64())], ["a", "b"])

    dealt = rows.select("a", "salt", "role", "id", "text").repartition("a", "salt").sortWithinPartitions("a", "salt", "role")
    links = scratch.keep(dealt.mapInArrow(run, "a long, b long"), "links")
    scratch.forget(asked)
    return links


def spanning(ids: list[list[int]], labels: list[list[int]], sets: list[list[np.ndarray]], threshold: int) -> list[tuple[int, int]]:
    """Links between documents of different components, enough to join all
    that are linked: each of ``ids[0]`` against all of ``ids[1]``, on the full
    sets.  Components that a link has joined count as one from then on."""
    if not sets[0] or not sets[1]:
        return []
    values, flat = np.unique(np.concatenate(sets[1]), return_inverse=True)
    size = np.array([len(s) for s in sets[1]])
    starts = np.concatenate(([0], np.cumsum(size)[:-1]))
    label = np.array(labels[1], dtype=np.int64)
    joined: dict[int, int] = {}

    def now(x: int) -> int:
        while x in joined:
            x = joined[x]
        return x

    out, flag = [], np.zeros(len(values), dtype=np.int32)
    for doc, own, mine in zip(ids[0], labels[0], sets[0], strict=True):
        other = label != now(own)
        if not other.any():
            continue
        place = np.minimum(np.searchsorted(values, mine), len(values) - 1)
        place = place[values[place] == mine]
        flag[place] = 1
        shared = np.add.reduceat(flag[flat], starts)
        flag[place] = 0
        for i in np.flatnonzero(other & (shared > 0) & (100 * shared >= threshold * (len(mine) + size - shared))).tolist():
            theirs, here = int(label[i]), now(own)
            if theirs != here:
                out.append((doc, ids[1][i]))
                joined[theirs] = here
                label[label == theirs] = here
    return out


def resolved(members: DataFrame, docs: DataFrame, k: int, threshold: int) -> DataFrame:
    """Links ``a, b`` that join the components in clusters of ``members``
    (``cluster, doc, component``), found by comparing, on the full sets, each
    document outside its cluster's largest component with all others.

    Both sides are dealt into tiles of about ``TILE`` documents, a task gets
    one pair of tiles at a time and returns at most a spanning set of links.
    """
    sizes = members.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n"))
    whole = sizes.groupBy("cluster").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"))
    tiles = whole.select(
        "cluster",
        F.col("top.component").alias("largest"),
        F.ceil((F.col("all") - F.col("top.n")) / F.lit(TILE)).cast("int").alias("ni"),
        F.ceil(F.col("all") / F.lit(TILE)).cast("int").alias("nj"),
    ).where("ni > 0")
    known = members.join(tiles, "cluster")
    row = known.where("component <> largest").withColumn("i", F.expr("cast(pmod(xxhash64(doc, 1), ni) as int)"))
    row = row.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nj") - 1)))
    column = known.withColumn("j", F.expr("cast(pmod(xxhash64(doc, 2), nj) as int)"))
    column = column.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("ni") - 1)))
    names = ["cluster", "i", "j", "role", "doc", "component"]
    dealt = row.withColumn("role", F.lit(0)).select(names).unionByName(column.withColumn("role", F.lit(1)).select(names))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["cluster", "i", "j"]):
            columns = [table.column(c).to_pylist() for c in ("cluster", "i", "j", "role", "doc", "component", "text")]
            mark = list(zip(*columns[:3], strict=True))
            cuts = [0, *(x for x in range(1, len(mark)) if mark[x] != mark[x - 1]), len(mark)] if mark else []
            found = []
            for x, y in zip(cuts, cuts[1:], strict=False):
                ids, labels, sets = [[], []], [[], []], [[], []]
                body = [t or b"" for t in columns[6][x:y]]
                every = [s for a, b in arrays.slices(body, 1 << 20) for s in shingle_sets(body[a:b], k)]
                for role, doc, component, values in zip(columns[3][x:y], columns[4][x:y], columns[5][x:y], every, strict=True):
                    if len(values):
                        ids[role].append(doc)
                        labels[role].append(component)
                        sets[role].append(values)
                found += spanning(ids, labels, sets, threshold)
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.int64()), pa.array([p[1] for p in found], pa.int64())], ["a", "b"])

    ready = dealt.join(texts, "doc").select(*names, "text").repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "role", "doc")
    return ready.mapInArrow(run, "a long, b long")


def linked(reps: DataFrame, docs: DataFrame, k: int, threshold: int, bands: int, rows: int, more: DataFrame | None = None) -> DataFrame:
    """``node, component`` of the documents that are linked with others.

    ``reps`` has ``doc_id, sig`` (``bands * rows`` minima) of documents with
    different shingle sets, ``docs`` their ``doc_id, text``; ``more`` adds
    links ``a, b`` known before.
    """
    width = 4 * rows
    cut = reps.select("doc_id", "sig", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band"))
    placed = cut.select(F.xxhash64("band", F.expr(f"substring(sig, band * {width} + 1, {width})")).alias("key"), F.col("doc_id").alias("doc"))
    buckets = placed.groupBy("key").agg(F.min("doc").alias("pivot"), F.max("doc").alias("last")).where("pivot <> last")
    hits = scratch.keep(placed.join(buckets.drop("last"), "key"), "hits")
    # The texts that are compared at all, fetched once.
    wanted = hits.select("doc").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    texts = scratch.keep(texts.join(wanted, texts.doc_id == wanted.doc, "left_semi"), "texts")
    return settled(hits, texts, k, threshold, more)


def settled(hits: DataFrame, texts: DataFrame, k: int, threshold: int, more: DataFrame | None = None, also: DataFrame | None = None) -> DataFrame:
    """``node, component`` of the documents that are linked with others: of all
    pairs that share a bucket of ``hits`` (``key, pivot, doc``, the pivot its
    smallest), and of the pairs ``also`` (``a, b``).  ``texts`` has ``doc_id,
    text`` of all of them; ``more`` are links known before."""
    pairs = hits.where("pivot <> doc").select(F.col("pivot").alias("a"), F.col("doc").alias("b"))
    pairs = scratch.keep((pairs if also is None else pairs.unionByName(also)).distinct(), "pairs")
    links = verified(pairs, texts, k, threshold)

    # Members that are not linked with their bucket's smallest: once more, with the one that has most links.
    failed = pairs.join(links, ["a", "b"], "left_anti")
    lone = hits.join(failed, (hits.pivot == failed.a) & (hits.doc == failed.b), "left_semi").select("key", "doc")
    ends = links.select(F.explode(F.array("a", "b")).alias("doc")).groupBy("doc").agg(F.count(F.lit(1)).alias("degree"))
    ranked = hits.join(ends, "doc").groupBy("key").agg(F.max(F.struct("degree", (-F.col("doc")).alias("doc"))).alias("best"))
    again = lone.join(ranked, "key").select((-F.col("best.doc")).alias("a"), F.col("doc").alias("b")).where("a <> b").distinct()
    again = again.join(pairs, ["a", "b"], "left_anti")
    links = links.unionByName(verified(again, texts, k, threshold))
    first = components(links.unionByName(more) if more is not None else links)

    # Buckets that still touch several components: what shares such a bucket's smallest is compared.
    state = hits.join(first, hits.doc == first.node, "left").select("key", "pivot", "doc", F.coalesce("component", "doc").alias("component"))
    state = scratch.keep(state, "buckets")
    spread = state.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    members = state.join(spread, "key").select(F.col("pivot").alias("cluster"), "doc", "component").distinct()
    late = scratch.keep(resolved(scratch.keep(members, "open"), texts, k, threshold), "links")
    known = first.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(known.unionByName(late))


def near_duplicates(docs: DataFrame, k: int = 5, threshold: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``:
    documents are linked if their shingle sets have a Jaccard similarity of
    at least ``threshold`` percent; ``kept`` marks each group's smallest id."""
    sigs = scratch.keep(signatures(docs, k), "signatures")
    real = sigs.where("doc_id is not null and digest is not null")
    classes = real.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    member = scratch.keep(real.select("doc_id", "digest").join(classes, "digest").select("doc_id", "rep"), "classes")
    reps = real.join(classes.withColumnRenamed("rep", "doc_id"), ["digest", "doc_id"], "left_semi").select("doc_id", "sig").distinct()

    # An id with several texts joins their classes.
    several = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("a", "b")
    groups = linked(reps, docs, k, threshold, BANDS, ROWS, several)
    place = member.join(groups, member.rep == groups.node, "left").select("doc_id", F.coalesce("component", "rep").alias("component_id"))
    place = place.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = sigs.select("doc_id", "n_shingles").join(place, "doc_id", "left")
    own = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))
