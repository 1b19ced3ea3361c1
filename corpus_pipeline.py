"""A corpus pipeline: drop toxic documents, near-duplicates and benchmark leaks, redact personal data, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All but the last
return the columns of ``documents``, whatever other columns come along.

Rows count by their texts: a null text counts as an empty one and is neither
toxic, a leak nor a duplicate. Rows with a null doc_id stay in every stage that
their text passes; repeated rows of one id and text are reduced to one by the
near-duplicate stage. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framequarry.llm import bpe, decontam, near_dedup, pii, toxicity
from framequarry.llm._shared import fresh_path, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model is fitted on labelled rows of ``docs``."""
    narrow = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return toxicity.drop_toxic(docs, toxicity.train(narrow, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, a resemblance of 0.8 or more)."""
    return near_dedup.drop_near_duplicates(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars`` is that of the new text."""
    return pii.redact_pii(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids."""
    return bpe.encode_documents(docs, bpe.default_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("pii", redact_personal_data),
    ("bpe", encode),
]

#: SQL can't express a trained classifier; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
