"""The registered queries: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.llm import bpe, brown_lm, collocations, decontamination, fingerprints, minhash_join, quality_rules, secret_scan, sharding, spelling, suffix_dedup, toxicity, url_filter
from tripwright.llm.common import crc_mod, read

TOXIC_FROM = 0.3


def toxic_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Learned from the labelled documents that are not held out."""
    learned = F.coalesce(crc_mod("doc_id", 4) != 2, F.lit(False))
    return toxicity.train(docs, labels, eligible=learned)


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = minhash_join.jaccard_join(read(spark, sf_dir, "documents"))
    return joined.select("doc_id", "class_id", "n_links", "n_copies", "n_linked_texts")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxic_model(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


# The rules of the page table.
URL_RULES = (
    url_filter.Rule("org", "/", True),
    url_filter.Rule("example.org", "/es/", False),
    url_filter.Rule("example.org", "/en/1", False),
    url_filter.Rule("com", "/fr/", True),
    url_filter.Rule("com", "/de/", False),
)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"), URL_RULES)


def byte_bpe(docs: DataFrame) -> DataFrame:
    """Token ids, and the digests of ids and decoded bytes, per document."""
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    both = bpe.encode_decode(docs, ranks, public_tokenizers.PATTERN)
    return both.select(
        "doc_id",
        "ids",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe(read(spark, sf_dir, "documents")).drop("ids")


def op5_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc_mod("doc_id", 5) == 1, F.lit(False))
    model, counts = brown_lm.train(docs.filter(~held_out).select("text"))
    return brown_lm.score(docs, model, counts).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Benchmark windows in each document: doc_id, n_words, n_hit and the items."""
    index = decontamination.build_index(docs, decontamination.asked_terms(benchmark), id_col)
    return decontamination.contamination(index, decontamination.search(index, benchmark))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents"))
    known = F.filter("findings", lambda f: f["kind"].isin(*secret_scan.KINDS))
    base = F.filter("findings", lambda f: f["layer"] == 0)
    counts = [
        F.size(F.filter(base, lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")
        for kind in secret_scan.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secret_scan.span_list(base), 256).alias("base_sha256"),
        secret_scan.span_list(known).alias("spans"),
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, texts = suffix_dedup.dedup(read(spark, sf_dir, "documents"))
    cut = texts.select("text_key", "n_removed", "n_spans", F.sha2("kept", 256).alias("cut_sha256"))
    none = F.lit(0).cast("long")
    return rows.join(cut, "text_key", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("cut_sha256", "same_sha256").alias("kept_sha256"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's slot and shard, and its shard once the last one has left."""
    docs = read(spark, sf_dir, "documents").select("doc_id", sharding.slot_of(F.col("doc_id")).alias("slot"))
    placed = sharding.assign(docs, "doc_id")
    return sharding.assign(placed, "doc_id", sharding.SHARDS[:-1], name="shard_after")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "stratum", "step_taken")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_toxicity": op2_toxicity,
    "op3_url_filter": op3_url_filter,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_brown_lm": op5_brown_lm,
    "op6_decontamination": op6_decontamination,
    "op7_fingerprints": op7_fingerprints,
    "op8_secret_scan": op8_secret_scan,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_sharding": op10_sharding,
    "op11_collocations": op11_collocations,
    "op12_quality_rules": op12_quality_rules,
    "op13_spelling_variants": op13_spelling_variants,
}
