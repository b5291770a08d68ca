"""The queries ``opN_<name>`` and ``pipeline``, and their SQL.

Each query applies an operator to the whole of its table.  The operators
keep their own outputs (spans, texts, files); the queries derive the result
columns from them.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from followgraph.llm import cnn, conversations, decontaminate, minhash, mixing, paragraphs, periods, perplexity, scratch, secret_scan, suffix_dedup, token_counts, toxicity, warc

TOKEN_LIMIT = 512
QUALITY_LINE = 0.7
TOXIC_LINE = 0.3
HELD_OUT = 2  # of crc32(doc_id) modulo 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds, with score and overlaps."""
    found = decontaminate.leaks(table(spark, sf_dir, "benchmark"))
    return table(spark, sf_dir, "documents").select("doc_id", found.alias("leaks")).select("doc_id", F.inline("leaks"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; a null text has none."""
    found = table(spark, sf_dir, "documents").select("doc_id", secret_scan.spans(spark).alias("found"))
    base = [r.kind for r in secret_scan.RULES if r.base]

    def of(kind):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(joined(F.filter("found", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat a smaller one's strings of 50 bytes."""
    found = suffix_dedup.kept(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    found = mixing.mixed(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents: 3-word shingles, 85 percent."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, threshold=85)


def op6_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of every document that a smaller one has too, removed."""
    found = paragraphs.kept(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        "doc_id", "n_shared", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "owners", F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages below the shared folder, read back."""
    folder = scratch.new(spark, "warc")
    manifest = warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(manifest, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and perplexity band of every document."""
    return perplexity.rules(table(spark, sf_dir, "documents"))


def tokenizer_file() -> str:
    """The vocabulary of the query, read on the driver."""
    import public_tokenizers

    return Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document; a null text has none of either."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", token_counts.deltas(spark, tokenizer_file()).alias("steps"))
    counted = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), token_counts.total("steps").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def quality_model(spark: SparkSession, sf_dir: str) -> cnn.Model:
    """The classifier fitted on the rows of ``labels`` that are not held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    seen = labels.where(F.crc32(F.col("doc_id").cast("string")) % 4 != HELD_OUT)
    return cnn.train(table(spark, sf_dir, "documents"), seen)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, empty and null texts included."""
    docs = table(spark, sf_dir, "documents")
    scored = docs.select("doc_id", cnn.score(docs, quality_model(spark, sf_dir)).alias("score"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= QUALITY_LINE).cast("int").alias("predicted"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after damage: its faults, the cheapest repair and its cost."""
    turns = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.digest(conversations.repair(turns, turns["present"]))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """The tagger fitted on the rows of ``labels`` that are not held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    seen = labels.where(F.crc32(F.col("doc_id").cast("string")) % 4 != HELD_OUT)
    return toxicity.train(table(spark, sf_dir, "documents"), seen)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, empty and null texts included, with
    the offending spans (``start:end`` in code points)."""
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", toxicity.tagged(docs, toxicity_model(spark, sf_dir)).alias("found")).select("doc_id", "found.*")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == HELD_OUT, F.lit(False))
    spans = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"], x["end"])), ",")
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_LINE).cast("int").alias("predicted"), spans.alias("spans")
    )


def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, some of which get a periodic tail first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", periods.planted().alias("text"))
    found = docs.select("doc_id", periods.collapse(spark).alias("found")).select("doc_id", "found.*")
    empty = F.lit(None).cast("struct<start: long, length: long, period: long>")
    # runs come by start and period, so the first of equal ones stays
    best = F.reduce(
        "runs", empty, lambda a, x: F.when(a.isNull() | (x["length"] * a["period"] > a["length"] * x["period"]), x).otherwise(a)
    )
    listed = F.array_join(F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_secret_scan": op2_secret_scan,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_mixing": op4_mixing,
    "op5_minhash": op5_minhash,
    "op6_paragraphs": op6_paragraphs,
    "op7_warc": op7_warc,
    "op8_perplexity": op8_perplexity,
    "op9_token_counts": op9_token_counts,
    "op10_quality": op10_quality,
    "op11_conversations": op11_conversations,
    "op12_toxicity": op12_toxicity,
    "op13_periods": op13_periods,
}
