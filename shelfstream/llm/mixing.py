"""Mixing sources to target weights.

Sizes (words) are summed per source; texts are never shuffled. Every source has a target
number of words; ``rate = target / size of the source``. A document is emitted ``floor(rate)``
times and once more with probability ``rate - floor(rate)``, decided by a hash of its id and a
seed. Of ``SEEDS`` seeds each source takes the one whose draw comes nearest its target; the sums
for all of them come from one aggregation.

Defined cases: null text has no words; a null source is a source of its own, last in order; rows
with the same id share their draw; a null id is an id like any other; a source without words has
rate 1; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfstream.llm.text import unused, whole, words
from shelfstream.operators.keys import dense_ids
from shelfstream.session import materialise

# fixed values: weights in the order of sources, share of all words, most uses of a word
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
SEEDS = 16


def draw(doc_id: str, seed: Column) -> Column:
    """A number in [0, 1) from the id and the seed."""
    text = F.concat_ws(":", seed.cast("string"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) of rows (source, source_size).

    Words are dealt by weight; what a source can't take is dealt again among the others, until
    none is above ``most`` times its size. A round is one sum over the sources."""
    ranked = dense_ids(sizes, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int")
    )
    weighed = materialise(
        ranked.select(
            "source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("most")
        ),
        "source-weights",
    )
    total = (weighed.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = 0.0, -1
    while True:
        at_most = F.col("weight") * level > F.col("most")
        row = weighed.agg(
            F.sum(F.when(at_most, F.col("most"))).alias("given"),
            F.sum(F.when(~at_most, F.col("weight"))).alias("weight"),
            F.count(F.when(at_most, 1)).alias("full"),
        ).first()
        if row["full"] == full or not row["weight"]:
            break
        full, level = row["full"], (total - (row["given"] or 0.0)) / row["weight"]
    share_of = F.when(F.col("weight") * level > F.col("most"), F.col("most")).otherwise(
        F.col("weight") * level
    )
    return weighed.select("source", "source_size", share_of.alias("target"))


def rates(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
          share: float = SHARE, most: float = MOST) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size) per document, and (source, source_size, target, rate, part, seed) per source."""
    sized = materialise(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
            F.size(words(whole(text))).cast("long").alias("size"),
        ),
        "sizes",
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rated = targets(sizes, share, most).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    )
    rated = materialise(rated.withColumn("part", F.col("rate") - F.floor("rate")), "rates")
    drawn = _join(sized, rated)
    tried = drawn.groupBy("source").agg(
        F.first("target").alias("target"),
        F.array(*[
            F.sum(F.col("size") * (F.floor("rate") + (draw("doc_id", F.lit(k)) < F.col("part")).cast("long")))
            for k in range(SEEDS)
        ]).alias("sums"),
    )
    far = F.transform("sums", lambda s: F.abs(s - F.col("target")))
    seeds = tried.select("source", (F.array_position(far, F.array_min(far)) - 1).alias("seed"))
    return sized, materialise(_join(rated, seeds), "seeds")


def plan(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
         share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, rate, copies, taken."""
    sized, chosen = rates(docs, doc_id, source, text, share, most)
    copies = F.floor("rate") + (draw("doc_id", F.col("seed")) < F.col("part")).cast("long")
    return _join(sized, chosen).select(
        "doc_id", "source", "size", "source_size", "target", "rate", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
        share: float = SHARE, most: float = MOST) -> DataFrame:
    """The documents with all their columns, each as often as the plan takes it. A row's copies follow from
    its id and its source, so texts meet only the table of sources."""
    _, chosen = rates(docs, doc_id, source, text, share, most)
    of, rate, part, seed, copy = unused(docs, "_mix_source", "_mix_rate", "_mix_part", "_mix_seed", "_mix_copy")
    small = chosen.select(
        F.col("source").alias(of), F.col("rate").alias(rate), F.col("part").alias(part), F.col("seed").alias(seed)
    )
    rated = docs.join(small, docs[source].cast("string").eqNullSafe(F.col(of)))
    copies = (F.floor(rate) + (draw(doc_id, F.col(seed)) < F.col(part)).cast("long")).cast("int")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return rated.select(*columns, F.explode(F.array_repeat(F.lit(1), copies)).alias(copy)).select(*columns)


def _join(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Add the columns of a source to its rows; many to one, so a hot source can be split."""
    right = sources.select(
        F.col("source").alias("_source"), *[c for c in sources.columns if c not in rows.columns]
    )
    return rows.join(right, rows["source"].eqNullSafe(right["_source"])).drop("_source")
