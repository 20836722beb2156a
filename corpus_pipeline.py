"""A training corpus from documents: toxic documents go, one of each group of near copies stays,
documents that hold a benchmark item go, sources are mixed to their weights, token ids are written.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before it kept. All
but the last return the columns of documents; the last returns what is read back from the token files,
one row per document and copy."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfstream.llm import containment, mixing, token_blocks, toxicity, weighted_minhash
from shelfstream.llm.text import table
from shelfstream.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return weighted_minhash.deduplicate(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return containment.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def write_token_blocks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_blocks.tokenize(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("token_blocks", write_token_blocks),
]

# classifiers, samples of shingles and tokenizers have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
