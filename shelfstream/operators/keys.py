"""Row identity: unique ids, dense ids and frequency-ordered id mappings.

No step sorts or numbers the whole table in one task. Dense ids come from a range
partitioning, a running number inside each partition and the partitions' offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfstream.session import materialise

# monotonically_increasing_id keeps the partition number above these bits
_SLOT_BITS = 33


def unique_ids(df: DataFrame, name: str = "id") -> DataFrame:
    """Prepend a unique, non-null long with gaps. No shuffle."""
    return df.select(F.monotonically_increasing_id().alias(name), "*")


def dense_ids(
    df: DataFrame, order: list[Column] | None = None, name: str = "id", ties: bool = False
) -> DataFrame:
    """Prepend ids 0..n-1 in the order ``order``, or in the order rows lie if not given.

    ``order`` must tell all rows apart. With ``ties`` it need not: rows are first written
    down with a running number that ends the sort key, so equal rows never have to share a
    partition, however many there are, and a task that runs again finds the same numbers.
    The partition sizes (one row per partition) are all that is summed in one place and
    broadcast."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    if order:
        if ties:
            df = materialise(
                df.withColumn("_arrival", F.monotonically_increasing_id()), "arrivals"
            )
            order = [*order, F.col("_arrival")]
        df = df.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns)
    staged = materialise(df.withColumn("_slot", F.monotonically_increasing_id()), "dense-ids")
    part = F.shiftright("_slot", _SLOT_BITS)
    sizes = staged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base")
    )
    within = F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    return (
        staged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_base") + within).alias(name), *columns)
    )


def frequency_ids(df: DataFrame, key: str, name: str) -> DataFrame:
    """Mapping (key, id, n): ids 0.. by falling frequency, ties by key; NULL keys have none.

    The counts are combined before the shuffle, and labels never reach the driver."""
    counts = (
        df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = dense_ids(counts, [F.desc("n"), F.asc(key)], name)
    return ranked.select(key, name, "n")
