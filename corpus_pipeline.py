"""Corpus pipeline: the documents that go into a training mix.

``STAGES`` run in order; each takes ``(spark, docs, sf_dir)``, and its
result is written as Parquet and read again as the next one's ``docs``.
Rows come out with the columns they went in with, extra ones too; the last
stage adds its own after them.  Ids may be null or repeated: rows are told
apart by a key of their whole contents (``followgraph.llm.rows``), and rows
equal in every column are one document.  An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from followgraph.llm import cnn, decontaminate, minhash, mixing, queries, rows, scratch, secret_scan

QUALITY_LINE = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = queries.quality_model(spark, sf_dir)
    return docs.where(cnn.score(docs, model) >= QUALITY_LINE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest
    id (null last), of several with that id the one with the smallest key.
    Rows with equal ids and unlike texts are documents of their own, and so are
    rows with null ids; of equal rows one stays.  Texts without words are near
    duplicates only of themselves under the same id."""
    node, row, many = (rows.free(docs, x) for x in ("node", "row", "many"))
    keyed = docs.withColumns({node: rows.key(docs, ["doc_id", "text"]), row: rows.key(docs)})
    narrow = keyed.groupBy(F.col(node).alias("node"), F.col(row).alias("row"), "doc_id").agg(F.count(F.lit(1)).alias("n"))
    groups = minhash.near_duplicates(keyed.select(F.col(node).alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("node"), "component_id").distinct()
    first = F.min(F.struct(F.isnull("doc_id").alias("last"), "doc_id", "node", "row", "n")).alias("first")
    best = narrow.join(groups, "node").groupBy("component_id").agg(first).select(F.col("first.row").alias(row), F.col("first.n").alias(many))
    return rows.one_each(keyed.drop(node).join(best, row), row, many).select([rows.column(c) for c in docs.columns])


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    leaks = decontaminate.leaks(queries.table(spark, sf_dir, "benchmark"))
    return docs.where(F.size(leaks) == 0)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a mark; ``n_chars`` follows the text."""
    name = "found"
    while name in docs.columns:
        name += "_"
    found = docs.withColumn(name, secret_scan.spans(spark))
    clean = found.withColumn("text", secret_scan.redacted("text", name)).drop(name)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes at least once, whole, with ``size,
    source_size, target, copies, taken`` (with underscores where ``docs`` has
    such columns).  Equal rows come out once, with the copies of all of them."""
    row, many = rows.free(docs, "row"), rows.free(docs, "many")
    keyed = docs.withColumn(row, rows.key(docs))
    mixed = mixing.mixed(keyed, key=row)
    added = {c: rows.free(docs, c) for c in ("size", "source_size", "target", "copies", "taken")}
    taken = mixed.groupBy(row).agg(
        F.count(F.lit(1)).alias(many),
        *[F.max(c).alias(added[c]) for c in ("size", "source_size", "target")],
        *[F.sum(c).alias(added[c]) for c in ("copies", "taken")],
    )
    taken = taken.where(F.col(added["copies"]) > 0)
    return rows.one_each(keyed.join(taken, row), row, many).select([rows.column(c) for c in [*docs.columns, *added.values()]])


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("secret scans", secrets),
    ("mixing sources", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


# The classifier and the near-duplicate groups cannot be stated in SQL.
ORACLE_SQL = None
