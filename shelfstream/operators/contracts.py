"""Row contracts: every input row ends up valid or rejected with a reason, never lost."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, functions as F

REASON = "reject_reason"
STATUS = "row_status"
VALID = "valid"
REJECTED = "rejected"


def with_reason(
    df: DataFrame,
    not_null: Iterable[str] = (),
    checks: Iterable[tuple[str, Column]] = (),
) -> DataFrame:
    """Add ``reject_reason``: the first rule a row breaks, NULL when it keeps them all.

    ``checks`` are (label, condition that is true for a bad row)."""
    rules = [(f"null:{name}", F.col(f"`{name}`").isNull()) for name in not_null]
    rules += list(checks)
    if not rules:
        return df.withColumn(REASON, F.lit(None).cast("string"))
    return df.withColumn(REASON, F.coalesce(*[F.when(bad, F.lit(why)) for why, bad in rules]))


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNull()).drop(REASON)


def rejected_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNotNull())


def reject_counts(df: DataFrame) -> DataFrame:
    return rejected_rows(df).groupBy(REASON).agg(F.count("*").alias("n"))


def write_split(df: DataFrame, path: str) -> None:
    """Valid and rejected rows side by side under ``path/row_status=…`` from a single pass."""
    status = F.when(F.col(REASON).isNull(), VALID).otherwise(REJECTED)
    df.withColumn(STATUS, status).write.mode("overwrite").partitionBy(STATUS).parquet(path)


def observed_counts(df: DataFrame, **others: Column) -> tuple[DataFrame, Observation]:
    """Row and reject counts, and counts of other values that are not NULL, taken while ``df`` is written,
    without a job of their own."""
    seen = Observation()
    marked = df.observe(
        seen,
        F.count(F.lit(1)).alias("messages"),
        F.count(F.col(REASON)).alias("rejected"),
        *[F.count(c).alias(name) for name, c in others.items()],
    )
    return marked, seen
