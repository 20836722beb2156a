"""Top-k, overall and per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def top_k(df: DataFrame, score: str, tie: str, k: int = 10) -> DataFrame:
    """The ``k`` highest scores, ties by key. Each task keeps k rows; no full sort."""
    return df.orderBy(F.desc(score), F.asc(tie)).limit(k)


def top_n_per_group(df: DataFrame, group: str, score: str, tie: str, n: int = 3) -> DataFrame:
    """The ``n`` best rows of every group. Spark cuts each task's share of a group to ``n``
    rows before the shuffle (window group limit), so a hot group stays small."""
    best = Window.partitionBy(group).orderBy(F.desc(score), F.asc(tie))
    return df.withColumn("_rn", F.row_number().over(best)).filter(F.col("_rn") <= n).drop("_rn")


def best_of_one(df: DataFrame, group: str, value, score: str, tie: str, n: int) -> DataFrame:
    """The ``n`` best rows of one given group."""
    return top_k(df.filter(F.col(group) == F.lit(value)), score, tie, n)
