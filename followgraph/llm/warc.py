"""Operator 7, WARC: a deterministic sharded writer, and a reader.

Records are dealt to shards by ranges of their id and, within one id, of their
payload's digest.  The bounds are exact quantiles of the bytes before each
record in that order, a prefix sum over range-sorted partitions, so they
depend on the table alone: not on the spread of the ids, nor on how Spark cut
the partitions.  Within a shard the records are sorted, so the same table
gives the same files, byte for byte, on any cluster.  A file is
closed when its compressed size reaches ``roll`` bytes.  Each record is a
gzip member with headers and digests made anew.

Of records with equal payloads of at least ``least`` bytes, the one with
the largest id is the response and the others revisit it.

Files are written under ``_temporary/<attempt>/`` and moved to their names
after the manifest, a Parquet table of the files of the attempts that
succeeded, has been committed; moving again after a failure does no harm.
Only files in the manifest belong to an archive.

A null payload is empty.  A null id is never referred to; it comes last,
and its record is a response unless the same payload has an id.  Of rows
that repeat the largest id with the same payload, the first is the response
and the others revisit it.  A null URI becomes ``urn:page:<id>``; bytes that
cannot stand in a header are percent-encoded.  An empty table gives an
empty manifest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from followgraph.llm import scratch, ship

SHARD_BYTES = 16 << 20
#: Bounds that come to the driver and are broadcast, at most (61 bytes each): beyond
#: as many shards, which are as many tasks, shards are larger than ``SHARD_BYTES``.
BOUNDS = 1 << 20
HEAD_BYTES = 400  # of a record, besides its payload
ROLL_BYTES = 4 << 20
DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard int, part int, name string, temporary string, records long, bytes long, sha256 string"


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder, local or remote."""
    if "://" not in folder and ":" in folder.split("/")[0]:
        scheme, path = folder.split(":", 1)  # file:/x
        folder = f"{scheme}://{path}"
    if folder.startswith(("s3a://", "s3n://")):  # other names of the same store
        folder = f"s3://{folder[6:]}"
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member with a WARC record."""
    head = [("WARC-Type", kind), *headers, ("WARC-Date", DATE), ("WARC-Block-Digest", f"sha1:{sha1(block)}"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return gzip.compress(text.encode() + block + b"\r\n\r\n", compresslevel=6, mtime=0)


def record_id(page: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}:{copy}')}>"


def page_record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, copy: int) -> bytes:
    """Response with the payload, or revisit with its HTTP header alone."""
    digest = sha1(payload)
    uri = quote(url, safe="%/:?#[]@!$&'()*+,;=-._~") if url else f"urn:page:{page}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Record-ID", record_id(page, digest, copy)),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("X-Page-Id", "" if page is None else str(page)),
    ]
    if refers_to is None:
        return record("response", headers, http + payload)
    return record("revisit", [*headers, ("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(refers_to, digest, 0)), ("X-Refers-To-Page-Id", str(refers_to))], http)


class Roller:
    """The files of one shard; yields a manifest row for each when it closes."""

    def __init__(self, folder: str, attempt: str, shard: int, roll: int):
        self.folder, self.attempt, self.shard, self.roll = folder, attempt, shard, roll
        self.part, self.out = 0, None

    def add(self, member: bytes) -> Iterator[tuple]:
        if self.out is None:
            self.name = f"pages-{self.shard:05d}-{self.part:05d}.warc.gz"
            self.temporary = f"_temporary/{self.attempt}/{self.name}"
            system, path = opened(self.folder)
            system.create_dir(f"{path}/_temporary/{self.attempt}", recursive=True)
            self.out = system.open_output_stream(f"{path}/{self.temporary}", compression=None)
            self.hash, self.size, self.records = hashlib.sha256(), 0, 0
            self._put(record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, self.name)}>"), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self._put(member)
        self.records += 1
        if self.size >= self.roll:
            yield from self.close()

    def _put(self, member: bytes) -> None:
        self.out.write(member)
        self.hash.update(member)
        self.size += len(member)

    def close(self) -> Iterator[tuple]:
        if self.out is not None:
            self.out.close()
            yield self.shard, self.part, self.name, self.temporary, self.records, self.size, self.hash.hexdigest()
            self.part, self.out = self.part + 1, None


def place(page_id: Column, sha: Column) -> Column:
    """Text that sorts as ``(page_id, sha)`` does, null ids last."""
    number = (page_id.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string")
    return F.concat(F.when(page_id.isNull(), "1").otherwise("0"), F.lpad(F.coalesce(number, F.lit("")), 20, "0"), sha)


def bounds(rows: DataFrame, shard_bytes: int = SHARD_BYTES) -> list[str]:
    """The least :func:`place` of each shard but the first, of ``rows`` (``page_id,
    sha, size``): a shard begins where the bytes before it pass a multiple of
    its size.  Copies of one payload under one id stay together (all but the
    first are records without payload)."""
    weights = rows.groupBy(place(F.col("page_id"), F.col("sha")).alias("place"))
    weights = weights.agg((F.max("size") + F.lit(HEAD_BYTES) * F.count(F.lit(1))).alias("bytes"))
    # Whatever the ranges that Spark samples are, the sum of all bytes before a record is the same.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    weights = scratch.keep(weights.repartitionByRange(parts, "place").withColumn("part", F.spark_partition_id()), "places")
    sums = sorted((r["part"], r["bytes"]) for r in weights.groupBy("part").agg(F.sum("bytes").alias("bytes")).collect())
    total = sum(n for _, n in sums)
    size = max(shard_bytes, -(-total // BOUNDS))
    before, offsets = 0, []
    for part, n in sums:
        offsets.append((part, before))
        before += n
    if total <= size:
        return []
    offset = F.broadcast(rows.sparkSession.createDataFrame(offsets, "part int, offset long"))  # a row for each partition
    here = Window.partitionBy("part").orderBy("place")
    upto = F.coalesce(F.sum("bytes").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("offset")
    shard = weights.join(offset, "part").select("part", "place", F.floor(upto / F.lit(size)).alias("shard"))
    new = shard.withColumn("old", F.lag("shard").over(here)).where("old is null or old <> shard")
    first: dict[int, str] = {}
    for r in new.orderBy("place").collect():  # BOUNDS rows and one for each partition at most
        first.setdefault(r["shard"], r["place"])
    return list(first.values())[1:]


def _shards(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` (``page_id, sha, payload``) with ``shard``, and the number of shards."""
    edges = bounds(rows.select("page_id", "sha", F.octet_length("payload").alias("size")))
    shared = rows.sparkSession.sparkContext.broadcast(np.array(edges, dtype="S61"))

    @F.arrow_udf("int")
    def shard(places: pa.Array) -> pa.Array:
        at = np.array(places.to_pylist(), dtype="S61")
        return pa.array(np.searchsorted(shared.value, at, side="right").astype(np.int32))

    return rows.withColumn("shard", shard(place(F.col("page_id"), F.col("sha")))), len(edges) + 1


def write(pages: DataFrame, folder: str, least: int = 0, roll: int = ROLL_BYTES) -> DataFrame:
    """Write the archives of ``pages`` (``page_id, url, html``) to ``folder``; returns the manifest."""
    spark = pages.sparkSession
    ship.package(spark)
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    placed, count = _shards(rows.withColumn("sha", F.sha1("payload")))
    # The owner of each payload: partial maxima first, so many equal payloads make few rows.
    narrow = placed.select("page_id", "sha", "shard", F.octet_length("payload").alias("size")).where(F.col("size") >= least)
    owner = narrow.groupBy("sha").agg(F.max("page_id").alias("owner"))
    notes = narrow.select("page_id", "sha", "shard").distinct().join(owner, "sha")
    notes = notes.select("shard", "page_id", F.lit(0).alias("kind"), "sha", "owner", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    bodies = placed.select("shard", "page_id", F.lit(1).alias("kind"), "sha", F.lit(None).cast("long").alias("owner"), "url", "payload")
    order = ["shard", F.col("page_id").asc_nulls_last(), "kind", "sha", "url"]
    dealt = notes.unionByName(bodies).repartitionByRange(count, "shard").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, roller = uuid.uuid4().hex, None
        here: tuple = ()
        owners: dict[str, int | None] = {}
        copies: dict[str, int] = {}

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            columns = zip(*done, strict=True) if done else [[]] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in MANIFEST.split(", ")])

        for batch in batches:
            done: list[tuple] = []
            for i in range(batch.num_rows):
                shard, page, kind, sha, owner, url, body = (c[i].as_py() for c in batch.columns)
                if roller is None or roller.shard != shard:
                    done += roller.close() if roller else []
                    roller = Roller(folder, attempt, shard, roll)
                if here != (shard, page):
                    here, owners, copies = (shard, page), {}, {}
                if kind == 0:
                    owners[sha] = owner
                    continue
                copy = copies.get(sha, 0)
                copies[sha] = copy + 1
                refers = owners.get(sha)
                if refers == page and copy == 0:
                    refers = None
                done += roller.add(page_record(page, url, body, refers, copy))
            yield batch_of(done)
        yield batch_of(list(roller.close()) if roller else [])

    dealt.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/_manifest")
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")

    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = opened(folder)
        for batch in batches:
            for name, temporary in zip(batch.column("name").to_pylist(), batch.column("temporary").to_pylist(), strict=True):
                if system.get_file_info(f"{path}/{temporary}").type == fs.FileType.File:
                    system.move(f"{path}/{temporary}", f"{path}/{name}")
                elif system.get_file_info(f"{path}/{name}").type != fs.FileType.File:
                    raise FileNotFoundError(name)
            yield batch

    published = manifest.repartition(max(1, count), "name").mapInArrow(publish, MANIFEST)
    published.agg(F.count(F.lit(1))).collect()
    system, path = opened(folder)
    if system.get_file_info(f"{path}/_temporary").type == fs.FileType.Directory:
        system.delete_dir(f"{path}/_temporary")
    return manifest


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, one at a time."""
    with gzip.GzipFile(fileobj=stream) as data:
        while line := data.readline():
            if line.strip() != b"WARC/1.1":
                raise ValueError("not a WARC record")
            headers = {}
            while (line := data.readline().rstrip(b"\r\n")):
                key, _, value = line.decode().partition(":")
                headers[key] = value.strip()
            block = data.read(int(headers["Content-Length"]))
            if data.read(4) != b"\r\n\r\n":
                raise ValueError("a record does not end")
            if headers["WARC-Block-Digest"] != f"sha1:{sha1(block)}":
                raise ValueError("a block does not have its digest")
            yield headers, block


PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """The pages in the archives of a manifest; a revisit's payload is null, its size and digest are those of the whole payload."""
    ship.package(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = opened(folder)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        names = [x.split()[0] for x in PAGES.split(", ")]
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, size = [], 0
                with system.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for headers, block in records(stream):
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        declared = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        whole = headers["WARC-Type"] == "response"
                        if whole and (len(payload) != declared or sha1(payload) != digest):
                            raise ValueError("a payload does not have its digest")
                        page, refers = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page-Id")
                        rows.append((int(page) if page else None, declared, digest, headers["WARC-Type"], int(refers) if refers else None, headers["WARC-Target-URI"], payload if whole else None))
                        size += len(payload)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    files = manifest.select("name", "bytes")
    return files.repartition(max(1, manifest.count()), "name").mapInArrow(run, PAGES)
