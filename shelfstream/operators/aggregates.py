"""Aggregations. Each has a partial step before its shuffle, so a hot key costs one row per
task and key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from shelfstream.functions.text import words_of


def group_count(df: DataFrame, key: str, column: str, name: str = "count") -> DataFrame:
    """Rows per key whose ``column`` is not NULL."""
    return df.groupBy(key).agg(F.count(column).alias(name))


def group_sum_above(df: DataFrame, key: str, column: str, least: float, name: str) -> DataFrame:
    """Sum per key, kept where it is above ``least``."""
    return df.groupBy(key).agg(F.sum(column).alias(name)).filter(F.col(name) > least)


def group_sum_above_sql(df: DataFrame, key: str, column: str, least: float, name: str) -> DataFrame:
    """The same through SQL text."""
    return df.sparkSession.sql(
        f"SELECT `{key}`, sum(`{column}`) AS `{name}` FROM {{rows}} "
        f"GROUP BY `{key}` HAVING sum(`{column}`) > :least",
        args={"least": least},
        rows=df,
    )


def word_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """Words of each line and how often they occur."""
    words = lines.select(F.explode(words_of(column)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def lines_of(texts: DataFrame, column: str = "text") -> DataFrame:
    """One row per line of a text column."""
    return texts.select(F.explode(F.split(F.col(column), "\n")).alias("value"))


def distinct_first(df: DataFrame, column: str, n: int) -> DataFrame:
    """The first ``n`` distinct values in their own order, so that runs repeat."""
    return df.select(column).distinct().orderBy(column).limit(n)


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows in each Spark partition that holds any."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def rmse(df: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """One row: root of the mean squared error."""
    error = F.col(prediction).cast("double") - F.col(label).cast("double")
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def mean_baseline_rmse(df: DataFrame, label: str = "rating") -> DataFrame:
    """Error of always predicting the mean, from one pass: the population deviation."""
    return df.agg(F.stddev_pop(F.col(label).cast("double")).alias("rmse"))


def union_all(tables: list[DataFrame]) -> DataFrame:
    """UNION ALL by position, under the first table's names."""
    return reduce(DataFrame.union, tables)
