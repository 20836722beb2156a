"""Joins. The many-row side may hold hot keys: AQE splits them, because the other side is
unique by key in every job here. Only sides of a known row bound are broadcast by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfstream.operators.contracts import REASON

# rows a side may have to be broadcast by hint; beyond it Spark picks the join
BROADCAST_ROWS = 10_000


def join_using(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join: the key once and first, then the left columns, then the right ones."""
    return left.join(right, [key], "inner")


def join_text_key(
    typed: DataFrame, text: DataFrame, key: str, key_type: str = "bigint"
) -> DataFrame:
    """Inner join of a numeric key with a text key. Text that is no number matches nothing
    and is dropped before the shuffle."""
    numeric = text.withColumn(key, F.col(key).try_cast(key_type)).filter(F.col(key).isNotNull())
    return typed.withColumn(key, F.col(key).cast(key_type)).join(numeric, [key], "inner")


def join_accounted(typed: DataFrame, text: DataFrame, key: str, key_type: str = "bigint") -> DataFrame:
    """Every row of ``text``, joined to the row of ``typed`` with its key: the key as a number, then the columns
    of ``typed`` and of ``text``, and ``reject_reason``: ``malformed:key``, ``unmatched:key`` or NULL where the
    join found a row.

    One outer join of the many-row side, which AQE can split at a hot key. ``typed`` is unique by key. Rows
    without a number for a key are dealt out by a hash of the row, or they would meet in one task."""
    here, there = [c for c in typed.columns if c != key], [c for c in text.columns if c != key]
    number = F.col(key).try_cast(key_type)
    dealt = F.when(number.isNull(), F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in text.columns]))
    many = text.select(
        number.alias(key), F.coalesce(dealt, F.lit(0).cast("bigint")).alias("_dealt"),
        *[F.col(f"`{c}`") for c in there],
    )
    found = typed.withColumns({
        key: F.col(key).cast(key_type), "_dealt": F.lit(0).cast("bigint"), "_found": F.lit(True)
    })
    joined = many.join(found, [key, "_dealt"], "left")
    reason = F.when(F.col(key).isNull(), f"malformed:{key}").when(F.col("_found").isNull(), f"unmatched:{key}")
    names = [F.col(f"`{c}`") for c in (key, *here, *there)]
    return joined.select(*names, reason.alias(REASON))


def join_few(many: DataFrame, few: DataFrame, key: str, rows: int) -> DataFrame:
    """Join with a side that has at most ``rows`` rows, such as a top-k."""
    if rows <= BROADCAST_ROWS:
        few = F.broadcast(few)
    return few.join(many, [key], "inner")


def reconcile(left: DataFrame, right: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    """Row counts (stage, n) of ``left`` and of its inner join with ``right``.

    Both sides shrink to one row per key and task before they are shuffled, and the joined
    rows are counted, not made."""
    n_left = left.groupBy(key).agg(F.count(F.lit(1)).alias("_l"))
    n_right = (
        right.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_r"))
    )
    totals = n_left.join(n_right, [key], "left").agg(
        F.coalesce(F.sum("_l"), F.lit(0)).alias("l"),
        F.coalesce(F.sum(F.col("_l") * F.col("_r")), F.lit(0)).alias("j"),
    )
    rows = F.array(
        F.struct(F.lit(names[0]).alias("stage"), F.col("l").alias("n")),
        F.struct(F.lit(names[1]).alias("stage"), F.col("j").alias("n")),
    )
    return totals.select(F.inline(rows))
