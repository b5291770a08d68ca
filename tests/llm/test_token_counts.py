"""Prefix counts against the tokenizer library, prefix by prefix."""

import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from followgraph.llm import queries
from followgraph.llm import token_counts as T
from tests.llm import corpus

PARTS = ["it's", "we'll", "they're", "I've", " ", "  ", "\n", "\n\n", "\t", " hello", "world", "apple", "ß", "日本", "😀", "123", " 45", "!!"]
PARTS += ["<|endoftext|>", "<|endof", "'", "'l", " ", "　", "\r\n", "a" * 40, "-----", "###", "thinlyhe"]


@pytest.fixture(scope="module")
def source():
    return Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")


@pytest.fixture(scope="module")
def library(source):
    out = Tokenizer.from_str(source)
    out.no_truncation()
    out.no_padding()
    return lambda text: len(out.encode(text, add_special_tokens=False).ids)


def texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(10))) for _ in range(n)]


def test_every_prefix(source, library):
    counter = T.Counter(source)
    for text in texts(400, 1):
        counts = np.cumsum(np.frombuffer(counter.deltas(text), dtype=np.int8), dtype=np.int64)
        assert [int(counts[len(text[:i].encode()) - 1]) for i in range(1, len(text) + 1)] == [library(text[:i]) for i in range(1, len(text) + 1)]


def test_many_at_once_and_a_small_memory(source, monkeypatch):
    counter, other = T.Counter(source), T.Counter(source)
    monkeypatch.setattr(T, "CACHE_BYTES", 900)
    some = texts(500, 2) + ["plain words here and there", " starts", "ends "]
    assert [d for i in range(0, len(some), 50) for d in counter.deltas_many(some[i : i + 50])] == [other.deltas(t) for t in some]


def test_long_strings_without_spaces_are_not_remembered(source, library):
    counter = T.Counter(source)
    rnd = random.Random(5)
    unspaced = ["".join(chr(rnd.randrange(0x4E00, 0x9FA0)) for _ in range(n)) for n in (30, 2000, 2000)] + ["x" * 3000, "a " + "é" * 500]
    got = counter.deltas_many(unspaced)
    assert [int(np.frombuffer(d, dtype=np.int8).sum(dtype=np.int64)) for d in got] == [library(t) for t in unspaced]
    assert max(map(len, counter.words), default=0) <= T.WORD and all(len(p.encode()) <= T.WIDE for p in counter.known)
    assert counter.held < T.KEPT_BYTES * 200


def test_given_table(spark, library):
    path = "/root/testdata/sf0.01"
    rows = queries.op9_token_counts(spark, path).collect()
    text = {r["doc_id"]: r["text"] for r in queries.table(spark, path, "documents").collect()}
    assert len(rows) == len(text) == 1000
    for r in rows:
        n = library(text[r["doc_id"]])
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(text[r["doc_id"]].encode()), n > 512)


def test_repeated_rows_and_extra_columns(spark, source, library):
    docs = spark.createDataFrame([(1, "it's so"), (1, "it's so"), (None, "it's so")], "doc_id long, text string").selectExpr("*", "1 steps_", "2 n")
    got = docs.withColumn("steps", T.deltas(spark, source)).select(T.total("steps").alias("tokens")).collect()
    assert [r["tokens"] for r in got] == [library("it's so")] * 3


def test_columns(spark, source, library):
    some = [*texts(40, 3), None, "", "apple pie " * 2000]
    docs = corpus.frame(spark, some).withColumn("steps", T.deltas(spark, source)).withColumn("end", F.octet_length("text"))
    rows = docs.select("doc_id", T.total("steps").alias("n"), T.count_at("steps", "end").alias("same"), T.longest_prefix("text", "steps", 7).alias("cut")).collect()
    for r in rows:
        text = some[r["doc_id"]] or ""
        assert r["n"] == library(text)
        assert r["same"] == (None if some[r["doc_id"]] is None else r["n"])
        fits = [i for i in range(len(text) + 1) if i == 0 or (i < 60 and library(text[:i]) <= 7)]
        assert r["cut"] == len(text[: max(fits)].encode())
    assert docs.where("doc_id < 0").collect() == []
