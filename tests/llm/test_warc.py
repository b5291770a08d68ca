"""Archives: round trip, revisits, the same bytes again, odd rows."""

import base64
import gzip
import hashlib
import random

from pyspark.sql import functions as F

from followgraph.llm import scratch, warc

SCHEMA = "page_id long, url string, html string, extra string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], SCHEMA)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, least=0):
    best = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= least:
            best[h or ""] = max(best.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        owner = best.get(h or "")
        visit = owner is not None and owner != i
        out.append((i, len((h or "").encode()), digest(h), "revisit" if visit else "response", owner if visit else None))
    return sorted(out, key=str)


def round_trip(spark, rows, least=0, **more):
    folder = scratch.new(spark, "warc")
    manifest = warc.write(pages(spark, rows), folder, least, **more)
    return folder, manifest, warc.read(manifest, folder)


def some(seed, n=80):
    rnd = random.Random(seed)
    pool = ["", None, "<p>é</p>", "x" * 3000, "\r\n\r\n", "WARC/1.1\r\n"]
    return [(i * 7, f"http://h/{i} é\n", rnd.choice(pool) if rnd.random() < 0.5 else f"<b>{rnd.random()}</b>") for i in range(n)]


def test_round_trip_and_revisits(spark):
    rows = some(1)
    for least in (0, 10):
        _, _, back = round_trip(spark, rows, least)
        got = back.collect()
        assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str) == expected(rows, least)
        html = {i: (h or "").encode() for i, _, h in rows}
        assert all(bytes(r["payload"]) == html[r["page_id"]] for r in got if r["record_type"] == "response")


def test_the_same_bytes_from_any_partitioning(spark):
    rows = some(2)
    shuffled = random.Random(3).sample(rows, len(rows))
    sums = []
    for part in (rows, shuffled):
        folder, manifest, _ = round_trip(spark, part, roll=1500)
        files = {r["name"]: r for r in manifest.collect()}
        assert len(files) > 3
        system, path = warc.opened(folder)
        for name, r in files.items():
            data = system.open_input_stream(f"{path}/{name}", compression=None).read()
            assert (len(data), hashlib.sha256(data).hexdigest()) == (r["bytes"], r["sha256"])
            assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        sums.append({n: r["sha256"] for n, r in files.items()})
        assert not [f for f in system.get_file_info(warc.fs.FileSelector(path)) if f.base_name == "_temporary"]
    assert sums[0] == sums[1]


def test_null_and_repeated_ids(spark):
    rows = [(None, None, "a"), (None, "u", "b"), (5, "u", "a"), (5, "u", "a"), (9, "u", "c"), (9, "u", "d")]
    _, _, back = round_trip(spark, rows)
    got = sorted(((r["page_id"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back.collect()), key=str)
    assert got == sorted([(None, digest("a"), "revisit", 5), (None, digest("b"), "response", None), (5, digest("a"), "response", None), (5, digest("a"), "revisit", 5), (9, digest("c"), "response", None), (9, digest("d"), "response", None)], key=str)


def test_empty_table(spark):
    _, manifest, back = round_trip(spark, [])
    assert manifest.count() == 0 and back.agg(F.count(F.lit(1))).first()[0] == 0


def shard_sizes(manifest):
    out = {}
    for r in manifest.collect():
        out[r["shard"]] = out.get(r["shard"], 0) + r["records"]
    return [out[k] for k in sorted(out)]


def test_signed_hash_ids_outliers_and_one_large_id_give_even_shards(spark, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 40_000)
    monkeypatch.setattr(warc.bounds, "__defaults__", (40_000,))
    rnd = random.Random(7)
    body = lambda: rnd.randbytes(500).hex()
    signed = [(rnd.randrange(-(1 << 63), 1 << 63), None, body()) for _ in range(300)] + [(-(1 << 63), "a", "x"), ((1 << 63) - 1, "b", "y")]
    outlier = [(i, None, body()) for i in range(300)] + [(1 << 62, None, body())]
    one = [(i, None, body()) for i in range(200)] + [(77, None, body()) for _ in range(100)] + [(None, None, body()) for _ in range(30)]
    for rows in (signed, outlier, one):
        _, manifest, back = round_trip(spark, rows)
        sizes = shard_sizes(manifest)
        assert len(sizes) >= 9 and max(sizes[:-1]) <= 1.5 * min(sizes[:-1])
        got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back.collect()), key=str)
        assert got == expected(rows)


def test_bounds_do_not_depend_on_the_partitions(spark):
    rnd = random.Random(8)
    rows = spark.createDataFrame([(rnd.choice([None, rnd.randrange(-50, 50), rnd.randrange(1 << 60)]), f"{rnd.randrange(1 << 30):040x}", rnd.randrange(900)) for _ in range(500)], "page_id long, sha string, size int")
    some = warc.bounds(rows, 9_000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert warc.bounds(rows.repartition(11), 9_000) == some and len(some) > 20
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    ids = [r["p"] for r in rows.select(warc.place(F.col("page_id"), F.col("sha")).alias("p"), "page_id", "sha").orderBy(F.col("page_id").asc_nulls_last(), "sha").collect()]
    assert ids == sorted(ids)
    assert warc.bounds(rows.limit(0), 9_000) == []
