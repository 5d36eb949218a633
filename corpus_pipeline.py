"""A corpus pipeline of five operators; every stage is written as Parquet and read again by the next.

The stages go from documents (doc_id, text, lang, source, n_chars) to token ids. Each works on all that
its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import bpe, decontamination, lines, quality, queries, similarity, storage, wordpieces


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier rejects; texts without words score the share of good labels."""
    storage.bounded_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, queries.quality_model(docs, labels), queries.ACCEPTED_SCORE)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops recurring lines after their first occurrence; a document that loses its last words goes, one that had none stays."""
    count = storage.free_name(docs, "n_dropped_lines")
    cut = lines.without_recurring_lines(docs, count=count)
    left = (F.col(count) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    n_chars = F.when(F.col(count) > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cut.where(left).withColumn("n_chars", n_chars).select(docs.columns)


def similarity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each component; repeated rows come once, rows without an id stay."""
    found = similarity.similar_documents(docs)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where(F.col("doc_id").isNull())).select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents into which a benchmark item leaks."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with a digest of what they decode to."""
    storage.bounded_batches(spark)
    path = wordpieces.tokenizer_path()
    tokens = bpe.decoded(bpe.encoded(docs, path), path)
    decoded = F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    return tokens.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", decoded)


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("similarity", similarity_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]

#: A trained classifier decides the first stage, which SQL can't state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = storage.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
