"""Filters written so that they reach the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def starts_with(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """The anchored literal prefix ``^prefix`` as ``startswith``, which file sources can use
    to skip row groups."""
    return df.filter(F.col(column).startswith(prefix))


def matches(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.filter(F.col(column).rlike(pattern))


def in_range(df: DataFrame, column: str, lower, upper) -> DataFrame:
    """``lower`` included, ``upper`` not. Bounds are literals of the column's own type, so
    the column is not cast and the filter is pushed down."""
    return df.filter((F.col(column) >= lower) & (F.col(column) < upper))


def equals(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))
