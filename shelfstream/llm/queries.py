"""Registered queries of this package, each over its whole tables, and SQL for those that have it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfstream.llm import (
    alignment, containment, hard_negatives, licenses, mixing, recompression, rule_forest, rule_stats, suffix_repeats, token_blocks,
    token_counts, toxicity, warc, weighted_minhash,
)
from shelfstream.llm.text import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@query
def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.tokenize(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = containment.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_held", "containment")


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


@query
def op4_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies"
    )


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "vote", "near_ids", "near_cosines")


@query
def op7_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_minhash.classes(table(spark, sf_dir, "documents"))


@query
def op8_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op10_rule_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rule_forest.filter_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *rule_stats.COUNTS, "base_failed", "score", "kept")


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), *paths)


@query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    )
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)
