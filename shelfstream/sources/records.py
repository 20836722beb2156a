"""Small typed records handed over by the caller."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, types as T

from shelfstream import schemas


def from_records(spark: SparkSession, rows: Iterable, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def from_pairs(spark: SparkSession, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(list(pairs), schemas.all_strings("key", "value"))
