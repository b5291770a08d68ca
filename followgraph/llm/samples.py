"""A bounded sample of labelled rows for fitting a classifier on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def labelled(docs: DataFrame, labels: DataFrame, max_rows: int, max_bytes: int) -> tuple[list[tuple], dict[int, int]]:
    """``(doc_id, label, whole text as bytes)`` by id, and the number of labelled
    documents of each class.

    Of each class at most ``max_rows`` rows are taken, those with the smallest
    hash of the id, and of these the first whose texts together have at most
    ``max_bytes`` bytes (whole texts only).  Repeated label rows of a document
    count once (their mean, rounded up), labels with null in either column
    are skipped, and of a repeated ``doc_id`` the least text counts.
    """
    known = (
        labels.select("doc_id", F.col("label").cast("double").alias("label"))
        .dropna()
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not sizes:
        return [], sizes
    chosen = None
    for label in sorted(sizes):
        few = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
        chosen = few if chosen is None else chosen.unionByName(few)
    by_hash = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # max_rows rows of each class at most
        .groupBy("doc_id", "label")
        .agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
        .withColumn("bytes", F.sum(F.octet_length("text")).over(by_hash.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("bytes") <= max_bytes)
        .select("doc_id", "label", F.col("text").cast("binary").alias("text"))
        .collect()
    )
    return sorted((r["doc_id"], r["label"], bytes(r["text"])) for r in rows), sizes
