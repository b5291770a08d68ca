import os
import uuid

import pytest

from followgraph.sources import sinks, text
from tests.conftest import edges_df

EDGE_LINES = [
    ("1\t2", (1, 2)),
    ("1\t2\t9", (1, 2)),
    ("3", None),
    ("x\t4", None),
    ("# c", None),
    ("", None),
    (" 5\t6", None),
    ("7\t 8", None),
    ('"9"\t10', None),
    ("11 12", None),
    ("13\t1.5", None),
    ("14\t99999999999999999999", None),
    ("-1\t-2", (-1, -2)),
    ("15\t15", (15, 15)),
]

TOPIC_LINES = [
    ("0\t0.2\t5.6\t4.2", (0, 0.2, 5.6, 4.2)),
    ("userId  games   movies  music", None),
    ("4\t1\t1", None),
    ("5\t\t1\t1", None),
    ("3\t-1\t1\t1", None),
    ("1\tNaN\t1\t1", "nan"),
    ("2\tInf\t1\t1", "inf"),
    ("6\t-0.0\t1\t1", (6, -0.0, 1.0, 1.0)),
]


def write_lines(base, lines):
    path = os.path.join(base, uuid.uuid4().hex)
    os.makedirs(path)
    with open(os.path.join(path, "part-0.tsv"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_edge_lines(spark, scratch_dir):
    path = write_lines(scratch_dir, [line for line, _ in EDGE_LINES])
    got = sorted((r["source"], r["destination"]) for r in text.read_edges(spark, path).collect())
    assert got == sorted(v for _, v in EDGE_LINES if v is not None)


def test_edge_repartition_auto(spark, scratch_dir):
    path = write_lines(scratch_dir, ["1\t2", "2\t3"])
    df = text.read_edges(spark, path, partitions="auto")
    par = spark.sparkContext.defaultParallelism
    assert df.rdd.getNumPartitions() == 2 * par
    assert df.count() == 2


def test_topic_lines(spark, scratch_dir):
    path = write_lines(scratch_dir, [line for line, _ in TOPIC_LINES])
    rows = {r["userId"]: r for r in text.read_topics(spark, path).collect()}
    assert sorted(rows) == [0, 1, 2, 6]
    assert rows[1]["games"] != rows[1]["games"]  # NaN passes the >= 0 filter
    assert rows[2]["games"] == float("inf")
    assert (rows[0]["games"], rows[0]["movies"], rows[0]["music"]) == (0.2, 5.6, 4.2)


def test_topic_header_option(spark, scratch_dir):
    path = write_lines(scratch_dir, ["userId\tgames\tmovies\tmusic", "0\t1\t2\t3"])
    with_header = text.read_topics(spark, path, header=True).collect()
    without = text.read_topics(spark, path, header=False).collect()
    assert with_header == without and len(without) == 1


def test_clean_strings(spark):
    df = spark.createDataFrame([("1", "2"), ("x", "2"), ("3", ""), ("4", None), ("-5", "6")], "source string, destination string")
    got = sorted(tuple(r) for r in text.clean_edges(df).collect())
    assert got == [(-5, 6), (1, 2)]


def test_validate_path():
    text.validate_path("/data/edges")
    text.validate_path("s3a://bucket/x", ("s3://", "s3a://", "s3n://"))
    with pytest.raises(ValueError):
        text.validate_path("/data/edges", ("s3://", "s3a://", "s3n://"))
    with pytest.raises(ValueError):
        text.validate_path("  ")


def test_missing_path_raises(spark, scratch_dir):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        text.read_edges(spark, os.path.join(scratch_dir, "does-not-exist")).collect()


@pytest.mark.parametrize(
    "size_mb, par, expect",
    [(None, 8, 32), (0, 8, 16), (128 * 100, 8, 100), (128 * 1000, 8, 160), (127, 8, 16)],
)
def test_plan_partitions(size_mb, par, expect):
    size = None if size_mb is None else size_mb * 1024 * 1024
    assert text.plan_partitions(size, par) == expect


def test_parquet_sinks(spark, scratch_dir):
    e = edges_df(spark, [(1, 2), (2, 3), (3, 1)]).repartition(3)
    p1 = os.path.join(scratch_dir, uuid.uuid4().hex)
    sinks.write_parquet(e, p1)
    sinks.write_parquet(e, p1)  # overwrite
    assert sorted(tuple(r) for r in spark.read.parquet(p1).collect()) == [(1, 2), (2, 3), (3, 1)]
    p2 = os.path.join(scratch_dir, uuid.uuid4().hex)
    sinks.write_parquet_single(e, p2)
    parts = [f for f in os.listdir(p2) if f.startswith("part-")]
    assert len(parts) == 1 and parts[0].endswith(".snappy.parquet")
    assert spark.read.parquet(p2).count() == 3


def test_input_size_and_fixed_partitions(spark, scratch_dir):
    path = write_lines(scratch_dir, ["1\t2", "2\t3", "3\t4"])
    assert text.input_size(spark, path) == len("1\t2\n2\t3\n3\t4\n")
    assert text.input_size(spark, os.path.join(scratch_dir, "missing-" + uuid.uuid4().hex)) is None
    df = text.read_edges(spark, path, partitions=3)
    assert df.rdd.getNumPartitions() == 3 and df.count() == 3
