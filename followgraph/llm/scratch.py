"""Tables in the shared folder that the session names in ``spark.checkpoint.dir``.

An operator that needs a result more than once writes it here and reads it
back, which also cuts its lineage: a lost executor costs a reread only.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; where none is set, a new local
    one for a session in one process (tests), and an error for a cluster."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-checkpoints-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def new(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Once it is written its shuffle files are of no more use, so Spark is told
    to delete them at the write's end instead of when the driver collects garbage.
    """
    spark = df.sparkSession
    path = new(spark, name)
    before = spark.conf.get(TIDY, "false")
    spark.conf.set(TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def forget(*frames: DataFrame) -> None:
    """Delete the folders below the shared one that these frames, made by
    :func:`keep`, read; nothing may read them later."""
    for df in frames:
        own = f"{folder(df.sparkSession)}/llm/"
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            at = path.rfind(own.split(":", 1)[-1].lstrip("/"))
            if at >= 0:
                remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`new`."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
