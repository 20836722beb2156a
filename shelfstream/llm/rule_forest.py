"""Quality rules: an isolation forest over rule statistics, calibrated on labelled rows.

Each tree cuts the space of the statistics at random features and random values, ``DEPTH`` times at
most. Every good labelled row of one half is dropped through every tree, and a place counts by its
share of them, as if the tree held ``SAMPLE`` rows: it is cut no further where that leaves one row.
A document that leaves the tree early is anomalous. The score is ``2 ** (-mean path / expected path)``,
and the threshold is the one with the best balanced accuracy on all labelled rows of the other half.
The forest is of fixed size (``TREES`` trees of 2 ** (``DEPTH`` + 1) - 1 places); its box, its counts
and its threshold come from all labelled rows, summed in tasks.

Defined cases: null text is empty; a document that fails a base rule is never kept; without
labelled rows of both kinds the base rules decide alone; ids may repeat or be null."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfstream.llm.rule_stats import COUNTS, MORE, with_statistics
from shelfstream.session import materialise

TREES = 100
SAMPLE = 256
DEPTH = 8
# fixed values of the base rules
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Rates of the rule statistics, none of which grows with the length of a text."""
    c = {k: np.asarray(v, np.float64) for k, v in counts.items()}
    words, chars, lines = (np.maximum(c[k], 1) for k in ("n_words", "word_chars", "n_lines"))
    return np.column_stack([
        c["n_symbols"] / chars, c["n_dup_lines"] / lines, c["n_repeat_words"] / words,
        c["n_upper"] / chars, c["n_marks"] / chars, c["word_chars"] / words,
        # distinct words fall with the length; their logarithm per logarithm of the length does not
        np.log1p(c["n_distinct"]) / np.log1p(words),
    ])


def expected_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of a random search tree of n rows; n may be a share of rows."""
    more = np.maximum(n, 2.0)
    return np.where(n <= 2, np.clip(n - 1, 0, 1), 2 * (np.log(more - 0.5) + np.euler_gamma) - 2 * (more - 1) / more)


def grow(low: np.ndarray, high: np.ndarray, rng: np.random.Generator, trees: int = TREES, limit: int = DEPTH) -> dict:
    """Arrays of all trees' nodes: feature (-1 at the deepest), value, left, right, depth."""
    feature, value, left, right, depths, roots = [], [], [], [], [], []
    spread = np.maximum(high - low, 1e-9)

    def node(box: tuple[np.ndarray, np.ndarray], depth: int) -> int:
        at = len(feature)
        for column, first in ((feature, -1), (value, 0.0), (left, at), (right, at), (depths, depth)):
            column.append(first)
        if depth >= limit:
            return at
        # splits fall in a box wider than the rows, so that what lies outside them is cut off early
        f = int(rng.integers(len(low)))
        feature[at], value[at] = f, float(rng.uniform(box[0][f], box[1][f]))
        upper, lower = box[1].copy(), box[0].copy()
        upper[f] = lower[f] = value[at]
        left[at] = node((box[0], upper), depth + 1)
        right[at] = node((lower, box[1]), depth + 1)
        return at

    for _ in range(trees):
        roots.append(node((low - 0.5 * spread, high + 0.5 * spread), 0))
    return {
        "feature": np.array(feature), "value": np.array(value), "left": np.array(left),
        "right": np.array(right), "depth": np.array(depths), "roots": np.array(roots), "limit": limit,
    }


def passing(forest: dict, rows: np.ndarray) -> np.ndarray:
    """How many of the rows come through each node."""
    held = np.zeros(len(forest["feature"]), np.int64)
    for root in forest["roots"]:
        at = np.full(len(rows), root)
        held[root] += len(rows)
        for _ in range(forest["limit"]):
            below = rows[np.arange(len(rows)), forest["feature"][at]] < forest["value"][at]
            at = np.where(below, forest["left"][at], forest["right"][at])
            held += np.bincount(at, minlength=len(held))
    return held


def weigh(forest: dict, held: np.ndarray, sample: int = SAMPLE) -> dict:
    """The forest with its path lengths, by the number of rows that come through each node."""
    total = int(held[forest["roots"][0]])
    mass = held * (min(sample, total) / total)
    forest["held"], forest["path"] = held, forest["depth"] + expected_path(mass)
    forest["feature"] = np.where(mass <= 1, -1, forest["feature"])
    forest["expected"] = max(1e-9, float(expected_path(np.float64(min(sample, total)))))
    return forest


def anomaly(forest: dict, rows: np.ndarray) -> np.ndarray:
    total = np.zeros(len(rows))
    for root in forest["roots"]:
        at = np.full(len(rows), root)
        for _ in range(forest["limit"]):
            f = forest["feature"][at]
            inner = f >= 0
            below = rows[np.arange(len(rows)), np.where(inner, f, 0)] < forest["value"][at]
            at = np.where(inner, np.where(below, forest["left"][at], forest["right"][at]), at)
        total += forest["path"][at]
    return 2.0 ** (-total / len(forest["roots"]) / forest["expected"])


def threshold(scored: DataFrame) -> float:
    """The cut of (score, bad) rows with the best balanced accuracy, halfway between two scores. Rows are summed
    per score and within ranges of scores; one sum per range is all that is added up in one place."""
    counts = scored.groupBy("score").agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"))
    counts = materialise(counts.repartitionByRange("score").withColumn("_part", F.spark_partition_id()), "scores")
    parts = counts.groupBy("_part").agg(F.sum("bad").alias("_bad"), F.sum("good").alias("_good"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    offsets = parts.select(
        "_part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("_bad", "_good")],
        *[F.sum(c).over(whole).alias(f"{c}_all") for c in ("_bad", "_good")],
    )
    upto = Window.partitionBy("_part").orderBy("score")
    cuts = counts.join(F.broadcast(offsets), "_part").select(
        "score", (
            (F.col("_bad_all") - F.col("_bad_before") - F.sum("bad").over(upto)) / F.col("_bad_all")
            + (F.col("_good_before") + F.sum("good").over(upto)) / F.col("_good_all")
        ).alias("worth"),
    )
    least = counts.agg(F.min("score")).first()[0]
    best = cuts.orderBy(F.desc("worth"), "score").first()
    if best.worth <= 1:  # no better than to cut below all
        return least - 1e-9
    after = counts.filter(F.col("score") > best.score).agg(F.min("score")).first()[0]
    return best.score + 1e-9 if after is None else (best.score + after) / 2


def fit(stats: DataFrame, labels: DataFrame, seed: int = 0) -> dict | None:
    """A forest and its threshold; stats: of with_statistics(), labels: (doc_id, quality)."""
    known = labels.select(F.col("doc_id").alias("_labelled"), F.col("quality").cast("int").alias("quality"))
    known = known.filter(F.col("quality").isin(0, 1) & F.col("_labelled").isNotNull())
    joined = stats.join(known, stats["doc_id"] == known["_labelled"]).select(
        *COUNTS, *MORE, (F.col("quality") == 0).alias("bad"),
        (F.xxhash64("doc_id", F.lit(seed)) % 2 == 0).alias("half"),
    )
    rows = materialise(_with(joined, FEATURES, (*COUNTS, *MORE), features), "labelled-rows")
    held = {
        (r.bad, r.half): r for r in rows.groupBy("bad", "half").agg(
            F.count(F.lit(1)).alias("n"),
            *[f(c).alias(f"{name}{c}") for name, f in (("low", F.min), ("high", F.max)) for c in FEATURES],
        ).collect()
    }
    n = {key: held[key].n if key in held else 0 for key in ((b, h) for b in (True, False) for h in (True, False))}
    bad, good = n[True, True] + n[True, False], n[False, True] + n[False, False]
    if bad + good < 8 or not bad or not good:
        return None
    train = rows.filter("not bad and half") if n[False, True] >= 8 else rows.filter("not bad")
    sides = [held[False, h] for h in ((True,) if n[False, True] >= 8 else (True, False)) if (False, h) in held]
    low = np.min([[r[f"low{c}"] for c in FEATURES] for r in sides], axis=0)
    high = np.max([[r[f"high{c}"] for c in FEATURES] for r in sides], axis=0)
    forest = _weighed(train, grow(low, high, np.random.default_rng(seed)))
    calibrate = rows.filter("not half") if n[True, False] and n[False, False] else rows
    scored = _with(calibrate, ["score"], FEATURES, lambda c: anomaly(forest, np.column_stack([c[f] for f in FEATURES]))[:, None])
    forest["threshold"] = threshold(scored.select("score", "bad"))
    return forest


FEATURES = [f"_f{i}" for i in range(7)]


def _with(rows: DataFrame, names: list[str], using: Sequence[str], made) -> DataFrame:
    """Rows with double columns made of the columns ``using`` of a batch, numbers without nulls."""
    before = rows.columns

    def run(batches):
        for batch in batches:
            new = made({c: batch.column(c).to_numpy() for c in using})
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(new[:, i]) for i in range(len(names))]], [*before, *names]
            )

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema]
    return rows.mapInArrow(run, ", ".join([*fields, *[f"{name} double" for name in names]]))


def _weighed(train: DataFrame, forest: dict) -> dict:
    """The forest with path lengths by all training rows: tasks count, and what comes to the driver is one
    number per node."""
    def run(batches):
        held = np.zeros(len(forest["feature"]), np.int64)
        for batch in batches:
            held += passing(forest, np.column_stack([batch.column(c).to_numpy() for c in FEATURES]))
        seen = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(held[seen])], ["node", "n"])

    counted = train.select(*FEATURES).mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("n")).toPandas()
    held = np.zeros(len(forest["feature"]), np.int64)
    held[counted["node"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    return weigh(forest, held)


def judge(stats: DataFrame, forest: dict | None) -> DataFrame:
    """Add base_failed, score (null without a forest) and kept to the statistics."""
    stats = stats.withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS)
        | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")),
    )
    if forest is None:
        return stats.withColumn("score", F.lit(None).cast("double")).withColumn("kept", ~F.col("base_failed"))
    scored = _with(stats, ["score"], (*COUNTS, *MORE), lambda c: anomaly(forest, features(c))[:, None])
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") <= forest["threshold"]))


def filter_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   seed: int = 0) -> DataFrame:
    """Per document: the statistics, base_failed, score and kept."""
    stats = materialise(with_statistics(docs, doc_id, text), "rule-statistics")
    return judge(stats, fit(stats, labels, seed))
