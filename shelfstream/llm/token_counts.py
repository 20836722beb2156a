"""Token counts of texts through a cache of digests.

A text is normalised as far as the tokenizer itself ignores differences, and digested (SHA-256). The
cache is a table of (digest, number of tokens), one folder per digest of the tokenizer: the bytes of
its file, its library's version and the normalisation. Digests that the cache does not hold are
encoded once each, however many documents share them, and appended to it.

The texts of misses are the only ones shuffled, copies within a task combined before. Where misses
are few, they are looked up by broadcast and the other texts stay where they are read.

Defined cases: null text is empty, with 0 bytes and 0 tokens; every row of repeated ids, texts or
whole rows has its count; null ids are kept; very long texts are encoded whole; other columns are
not looked at; an empty table gives no row and leaves the cache as it is."""

from __future__ import annotations

import hashlib
import importlib.metadata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from shelfstream.llm import word_ids
from shelfstream.llm.text import SPACES, whole
from shelfstream.session import fresh_path, materialise

CACHE = "digest binary, n_tokens long"
LIMIT = 2048


def tokenizer_digest(path: str) -> str:
    """Names the file's bytes, the library that runs it and the normalisation before the digest."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as file:
        digest = hashlib.sha256(file.read())
    digest.update(f"{library} {importlib.metadata.version(library)} apart={word_ids.words_apart(path)}".encode())
    return digest.hexdigest()


def normalised(text: Column, tokenizer: str) -> Column:
    """The text with differences removed that the tokenizer ignores: runs of ASCII white space, where
    its rules read any of them as one space. Letter case is kept, since special tokens have one."""
    return F.regexp_replace(text, SPACES, " ") if word_ids.words_apart(tokenizer) else text


def cached_counts(spark: SparkSession, folder: str) -> DataFrame | None:
    """The stored counts, a digest once even if two jobs appended it; None where nothing is stored."""
    try:
        stored = spark.read.schema(CACHE).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return stored.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def encode_misses(texts: DataFrame, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) of rows (digest, norm)."""
    def run(batches):
        encoder = word_ids.encoder_of(tokenizer)
        for batch in batches:
            counts = [encoder.count(slab) for slab in word_ids.text_slabs(batch.column("norm"))]
            counts = np.concatenate([np.zeros(0, np.int64), *counts])
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return texts.select("digest", "norm").mapInArrow(run, CACHE)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = LIMIT,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row. ``cache`` is a folder that all executors
    reach; without one, a new cache in the shared folder serves this call."""
    spark = docs.sparkSession
    folder = f"{(cache or fresh_path(spark, 'token-counts')).rstrip('/')}/tokenizer={tokenizer_digest(tokenizer)}"
    keyed = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    keyed = keyed.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), normalised(F.col("text"), tokenizer).alias("norm")
    ).withColumn("digest", F.unhex(F.sha2("norm", 256)))
    distinct = keyed.groupBy("digest").agg(F.min("norm").alias("norm"))
    stored = cached_counts(spark, folder)
    if stored is not None:
        missed = keyed.select("digest").distinct().join(stored, "digest", "left_anti")
        distinct = distinct.join(materialise(missed, "token-count-misses"), "digest", "left_semi")
    encode_misses(distinct, tokenizer).write.mode("append").parquet(folder)
    # a plain table, so that AQE can split the rows of a digest that many documents share
    counts = materialise(cached_counts(spark, folder), "token-counts")
    return keyed.select("doc_id", "n_bytes", "digest").join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
