"""Generated names: every first name with every last name of a country, sampled.

The pairs of a country with F first and L last names are numbered 0..F*L-1. A sample is drawn
from the numbers, and a number k is then looked up: first name k div L, last name k mod L. So
only the pairs that are kept are ever made, by two equi joins; there is no cross join.

``name_pairs`` tests every pair's number against a rule. ``drawn_pairs`` draws the gaps between kept numbers
instead, so its work follows what it keeps."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfstream.operators.aggregates import union_all
from shelfstream.operators.keys import dense_ids, unique_ids
from shelfstream.operators.sampling import in_share
from shelfstream.session import materialise
from shelfstream.sources.files import write_quoted

# pair numbers made from one row; keeps the arrays they come from small
_CHUNK = 1 << 16
# pairs that a run of numbers keeps, about
_KEPT = 4096


def numbered(names: DataFrame, group: str, column: str) -> DataFrame:
    """(group, column, pos): position 0.. inside each group, in the order of the names."""
    ids = dense_ids(names.select(group, column), [F.asc(group), F.asc(column)], "_id", ties=True)
    ids = materialise(ids, "name-ids")
    first = ids.groupBy(group).agg(F.min("_id").alias("_first"))
    return ids.join(first, group).select(group, column, (F.col("_id") - F.col("_first")).alias("pos"))


def by_share(fraction: float, seed: int):
    """Keep about ``fraction`` of the pairs. Decided by a hash of the pair's number, so a task
    that runs again keeps the same ones. Shares finer than the hash are refused."""
    return lambda group, k: in_share(F.xxhash64(group, k), fraction, seed)


def name_pairs(first: DataFrame, last: DataFrame, group: str, keep=None) -> DataFrame:
    """(group, firstname, lastname) of the pairs for which ``keep(group, number)`` is true;
    all of them without ``keep``. Repeated names make repeated pairs.

    ``first`` is (group, firstname), ``last`` is (group, lastname)."""
    firsts, lasts, sizes = _numbered_sides(first, last, group)
    pairs = F.col("_f") * F.col("_l")
    # a set number of tasks: AQE would merge partitions by the few bytes a chunk has now
    tasks = int(first.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = sizes.select(
        group, "_l", pairs.alias("_pairs"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), pairs - 1, F.lit(_CHUNK).cast("bigint")))
        .alias("_start"),
    ).repartition(tasks, F.col(group), F.col("_start"))
    end = F.least(F.col("_start") + _CHUNK, F.col("_pairs")) - 1
    numbers = chunks.select(group, "_l", F.explode(F.sequence("_start", end)).alias("_k"))
    if keep is not None:
        numbers = numbers.filter(keep(F.col(group), F.col("_k")))
    return _looked_up(numbers, firsts, lasts, group)


def _numbered_sides(first: DataFrame, last: DataFrame, group: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both sides numbered, and (group, _f, _l): how many names each side of a group has."""
    firsts = numbered(first, group, "firstname")
    lasts = numbered(last, group, "lastname")
    sizes = firsts.groupBy(group).agg(F.count(F.lit(1)).alias("_f")).join(
        lasts.groupBy(group).agg(F.count(F.lit(1)).alias("_l")), group
    )
    return firsts, lasts, sizes


def _looked_up(numbers: DataFrame, firsts: DataFrame, lasts: DataFrame, group: str) -> DataFrame:
    """The names of pair numbers (group, _l, _k)."""
    places = numbers.select(
        group,
        F.expr("_k div _l").alias("_i"),
        (F.col("_k") % F.col("_l")).alias("_j"),
    )
    return (
        places.join(firsts.withColumnRenamed("pos", "_i"), [group, "_i"])
        .join(lasts.withColumnRenamed("pos", "_j"), [group, "_j"])
        .select(group, "firstname", "lastname")
    )


def _gaps(rng: np.random.Generator, share: float, length: int) -> np.ndarray:
    """The numbers below ``length`` that are kept, each with probability ``share``: sums of geometric gaps."""
    out, at = [], -1
    while at < length:
        more = max(64, int((length - at) * share * 1.1))
        places = at + np.cumsum(rng.geometric(share, more))
        out.append(places)
        at = int(places[-1])
    places = np.concatenate(out) if out else np.zeros(0, np.int64)
    return places[places < length]


def drawn_numbers(sizes: DataFrame, group: str, share: float, seed: int) -> DataFrame:
    """(group, _l, _k): about ``share`` of the pair numbers 0.._pairs-1 of each group of (group, _l, _pairs).

    A group's numbers are cut into runs that keep some thousand each; within a run the gaps between kept numbers
    are drawn from the run's own seed. A gap says nothing about the next, so drawing anew at the start of a run
    changes no chance, and a task that runs again draws the same."""
    run = min(max(_KEPT, math.ceil(_KEPT / Fraction(share))), 1 << 48)
    length = F.lit(run).cast("bigint")
    runs = F.ceil(F.col("_pairs") / length).cast("bigint")
    # two steps, or one row would hold an array of all run numbers
    blocks = sizes.filter("_pairs > 0").withColumn("_runs", runs).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_runs - 1) div {_CHUNK}")))
    )
    first = F.col("_block") * _CHUNK
    numbered = blocks.repartition(F.col(group), "_block").withColumn(
        "_run", F.explode(F.sequence(first, F.least(first + _CHUNK, F.col("_runs")) - 1))
    )
    rows = numbered.select(
        group, "_l", (F.col("_run") * length).alias("_start"),
        F.least(length, F.col("_pairs") - F.col("_run") * length).alias("_length"),
        F.xxhash64(F.lit(seed), group, "_run").alias("_seed"),
    )
    fields = f"{group} {dict(sizes.dtypes)[group]}, _l bigint, _k bigint"

    def draw(batches):
        for batch in batches:
            for i, (start, size, key) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("_start", "_length", "_seed")])):
                kept = start + _gaps(np.random.default_rng(key % 2**64), share, size)
                again = pa.array(np.full(len(kept), i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(group).take(again), batch.column("_l").take(again), pa.array(kept, pa.int64())],
                    [group, "_l", "_k"],
                )

    return rows.mapInArrow(draw, fields)


def drawn_pairs(first: DataFrame, last: DataFrame, group: str, n: int | None = None, share: float | None = None,
                seed: int = 0) -> DataFrame:
    """(group, firstname, lastname) of pairs drawn without replacement: about ``n`` of all, or about ``share`` of
    them. Work and memory follow the names and the pairs that are drawn, not the pairs there are."""
    firsts, lasts, sizes = _numbered_sides(first, last, group)
    sizes = sizes.select(group, "_l", (F.col("_f") * F.col("_l")).alias("_pairs"))
    if n is not None:
        there = sizes.agg(F.sum(F.col("_pairs").cast("double"))).first()[0] or 0.0
        share = min(1.0, n / there) if there else 1.0
    if not 0 < share <= 1:
        raise ValueError(f"cannot draw a share of {share}")
    return _looked_up(drawn_numbers(sizes, group, share, seed), firsts, lasts, group)


def generated_names(
    countries: list[DataFrame], fraction: float = 0.30, seed: int = 0, n: int | None = None
) -> DataFrame:
    """(id, firstname, lastname) from one table of (first_name, last_name) per country: a share of all pairs,
    or about ``n`` of them."""
    tagged = [c.select(F.lit(i).alias("_country"), "first_name", "last_name")
              for i, c in enumerate(countries)]
    names = union_all(tagged)
    pairs = drawn_pairs(
        names.select("_country", F.col("first_name").alias("firstname")),
        names.select("_country", F.col("last_name").alias("lastname")),
        "_country", n, None if n is not None else fraction, seed,
    )
    return unique_ids(pairs.select("firstname", "lastname"))


def export_names(names: DataFrame, path: str, one_file: bool = False) -> None:
    write_quoted(names, path, one_file)
