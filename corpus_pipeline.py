"""A training corpus in five stages, each over all that the stage before kept.

Each stage takes (spark, docs, sf_dir) and returns documents with their columns
as they were; the last one returns token ids. Rows are told apart by id and text,
so repeated ids and null ids are handled like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.llm import minhash_join, secret_scan, toxicity
from tripwright.llm.common import free_name, read, row_key, written
from tripwright.llm.queries import TOXIC_FROM, byte_bpe, leaks, toxic_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model is learned from the labelled ones."""
    return toxicity.keep_clean(docs, toxic_model(docs, read(spark, sf_dir, "labels")), TOXIC_FROM)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the least id."""
    return minhash_join.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    key = free_name(docs, "leak_key")
    keyed = docs.withColumn(key, F.unhex(row_key()))
    found = leaks(keyed, read(spark, sf_dir, "benchmark"), key).filter("n_hit > 0")
    hit = found.select(F.col("doc_id").alias(key))
    return keyed.join(hit, key, "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets, also encoded ones, are replaced by a mark; n_chars follows the text."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else clean


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document with their count, and digests of ids and decoded bytes."""
    return byte_bpe(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secret_scan", redact_secrets),
    ("byte_bpe", tokenize),
]
# A fitted classifier decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each written and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
