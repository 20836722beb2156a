"""Benchmark decontamination: short test items inside long documents.

Texts are sets of five-word shingles, hashed. An item with n shingles is in a document that has at
least ``ceil(THRESHOLD * n)`` of them. Items are partitioned by size (powers of two); of each item the
MinHash sketch is its k smallest hashes, k being one more than the most that a document may lack at
the largest size of the partition, so no document that holds the item misses the whole sketch. The
shingles of every document are looked up in the sketches; pairs that meet are verified by exact
containment. A document's own MinHash would not do: an item of 40 words is one in a hundred of the
shingles of a long document. Only DataFrame expressions run. Sketches and candidates are written
tables, so Spark knows their size when it chooses between broadcast and shuffle.

Defined cases: null text is empty; items with fewer than five words have no shingle and are in no
document; null ids, of documents or items, are kept in the results; items that share an id are looked
for one by one; repeated rows each have their own result; other columns, whatever their names, are
kept by ``decontaminate``; empty tables give empty results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfstream.llm.text import row_key, unused, whole
from shelfstream.session import materialise

SHINGLE = 5
THRESHOLD = 0.8
BETWEEN = r"[^\p{L}\p{N}]+"


def shingled(rows: DataFrame, name: str) -> DataFrame:
    """Replace the column ``text`` by the hashes of its five-word shingles, repeats included. The words
    are a column of their own first, so that they are split once per text and not once per shingle."""
    kept = [c for c in rows.columns if c != "text"]
    split = rows.select(*kept, F.array_remove(F.split(F.lower("text"), BETWEEN), "").alias("_words"))
    hashes = F.when(
        F.size("_words") >= SHINGLE,
        F.transform(
            F.sequence(F.lit(0), F.size("_words") - SHINGLE),
            lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(SHINGLE)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    return split.select(*kept, hashes.alias(name))


def need(n: Column, threshold: float = THRESHOLD) -> Column:
    return F.ceil(n * F.lit(threshold) - F.lit(1e-9)).cast("int")


def sketches(items: DataFrame, item_id: str = "item_id", text: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """(item, item_id, hashes, n, need, sketch) of items that have shingles; ``item`` is a key of id and text."""
    rows = items.select(F.col(item_id).alias("item_id"), whole(text).alias("text"))
    hashed = shingled(rows.withColumn("item", row_key("item_id", "text")), "hashes")
    hashed = materialise(
        hashed.select("item", "item_id", F.array_sort(F.array_distinct("hashes")).alias("hashes")), "item-shingles"
    ).filter(F.size("hashes") > 0)
    largest = F.pow(F.lit(2.0), F.floor(F.log2(F.size("hashes"))) + 1).cast("int") - 1
    return hashed.select(
        "item", "item_id", "hashes", F.size("hashes").alias("n"), need(F.size("hashes"), threshold).alias("need"),
        F.slice("hashes", F.lit(1), largest - need(largest, threshold) + 1).alias("sketch"),
    )


def find(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(key, doc_id, item_id, n_shingles, n_held, containment) of all documents that hold an item."""
    known = materialise(sketches(items, item_id, item_text, threshold), "item-sketches")
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    keyed = rows.select(row_key("doc_id", "text").alias("key"), "doc_id", "text")
    probes = materialise(known.select("item", "need", F.explode("sketch").alias("hash")).distinct(), "item-probes")
    # The number of shingles is taken before they are dealt out, so that no row drags the array along.
    # explode() would filter on the array, and the optimizer would push the whole expression into that.
    sized = shingled(keyed.select("key", "text"), "hashes").select("key", F.size("hashes").alias("size"), "hashes")
    met = (
        sized.select("key", "size", F.explode_outer("hashes").alias("hash"))
        .join(probes, "hash").filter(F.col("size") >= F.col("need"))
    )
    candidates = materialise(met.select("key", "item").distinct(), "candidates")
    asked = materialise(candidates.select("key").distinct(), "candidate-keys")
    found = shingled(keyed.join(asked, "key", "left_semi"), "in_doc")
    pairs = found.join(candidates, "key").join(known, "item")
    held = F.size(F.array_intersect("in_doc", "hashes"))
    return (
        pairs.select("key", "doc_id", "item_id", F.col("n").alias("n_shingles"), "need", held.alias("n_held"))
        .filter(F.col("n_held") >= F.col("need"))
        .select("key", "doc_id", "item_id", "n_shingles", "n_held",
                (F.col("n_held") / F.col("n_shingles")).alias("containment"))
    )


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    plain, key, bad = unused(docs, "_plain", "_plain_key", "_bad_key")
    leaks = materialise(find(docs, items, doc_id, text, **names).select(F.col("key").alias(bad)).distinct(), "leaks")
    fields = F.struct(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))
    keyed = docs.withColumn(plain, fields).withColumn(key, row_key(f"{plain}.doc_id", f"{plain}.text"))
    return keyed.join(leaks, F.col(key) == F.col(bad), "left_anti").drop(plain, key)
