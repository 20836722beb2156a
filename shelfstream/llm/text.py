"""Word counting, row keys and casts shared by the operators of this package."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# the six ASCII white-space characters: space, tab, newline, vertical tab, form feed, return
SPACES = r"[\x20\x09-\x0D]+"
MARKS = 1 << 18  # rows of 64 places that are broadcast at most


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(column: str) -> Column:
    """A text column with nulls read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, unchanged, as an array."""
    return F.array_remove(F.split(text, SPACES), "")


def unused(rows: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until none is a column of ``rows``."""
    taken, out = {c.lower() for c in rows.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def row_key(*columns: str) -> Column:
    """A 64-bit key of the given columns; equal rows share it, nulls are a value of their own."""
    return F.xxhash64(*[
        part for c in columns
        for part in (F.col(c).isNull(), F.coalesce(F.col(c).cast("string"), F.lit("")))
    ])


def first_by_hash(rows: DataFrame, hashed: Column, most: int, *ties: Column | str) -> DataFrame:
    """The ``most`` rows of smallest 64-bit hash. Rows behind a hash before which, as counted, there are
    enough go in their own tasks, so the task that orders the rest takes in little more than ``most``."""
    total = rows.count()
    share, near = (most + 6 * math.sqrt(most)) / max(total, 1), rows
    while share < 1:
        before = rows.filter(hashed <= F.lit(int((share - 0.5) * 2**64)))
        if before.count() >= most:
            near = before
            break
        share *= 2
    return near.orderBy(hashed, *ties).limit(most)


def possible(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose whole-number key may be one of the written ``wanted``: all of those and a few others, so that
    a join that follows moves little else. Keys wanted are marked in at most ``MARKS`` times 64 places, which
    are broadcast; beyond some millions of keys more and more others come along."""
    (place, word, marks), n = unused(rows, "_place", "_word", "_marks"), wanted.count()
    places = 64 * min(MARKS, 1 << max(4, (n // 4).bit_length()))
    placed = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(places))
    marked = wanted.select(placed.alias(place)).groupBy(F.shiftright(place, 6).alias(word)).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({place} % 64 as int))")).alias(marks)
    )
    met = rows.withColumn(place, placed).join(F.broadcast(marked), F.shiftright(place, 6) == F.col(word))
    return met.filter(F.expr(f"getbit({marks}, cast({place} % 64 as int)) = 1")).drop(place, word, marks)
