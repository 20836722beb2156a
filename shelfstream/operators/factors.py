"""Alternating least squares that splits hot users and items.

Spark ML's solver gathers all ratings of one user (or item) in one task. Here a task adds up the
normal equations of a block of ids, reads its packed ratings slice by slice, and a single user or
item with too many ratings lies in all blocks (``operators.factor_blocks``). Each half step sends
the packed ratings and one copy of a vector per block that needs it."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfstream.operators import factor_blocks
from shelfstream.session import materialise

FACTOR_SCHEMA = "id long, features array<float>"


def starting_factors(ids: DataFrame, rank: int, seed: int) -> DataFrame:
    """Vectors of about unit length, drawn from a hash of (seed, id, position)."""
    scale = 1e6 * math.sqrt(rank / 3.0)
    values = [
        (F.pmod(F.xxhash64(F.lit(seed), "id", F.lit(i)), F.lit(2_000_001)) - 1_000_000) / scale
        for i in range(rank)
    ]
    return ids.select("id", F.array(*[v.cast("float") for v in values]).alias("features"))


def _pairs(rank: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(rank) for j in range(i, rank)]


def _spread_out(factors: DataFrame, rank: int) -> DataFrame:
    """One double column per position, so that sums over products read plain columns."""
    return factors.select("id", *[
        F.get("features", F.lit(i)).cast("double").alias(f"_v{i}") for i in range(rank)
    ])


def _whole_gram(factors: DataFrame, rank: int) -> np.ndarray:
    """Sum of all outer products: one row of rank * (rank + 1) / 2 numbers."""
    values = [F.col(f"_v{i}") for i in range(rank)]
    row = _spread_out(factors, rank).agg(
        *[F.sum(values[i] * values[j]) for i, j in _pairs(rank)]
    ).first()
    gram = np.zeros((rank, rank))
    for total, (i, j) in zip(row, _pairs(rank)):
        gram[i, j] = gram[j, i] = total
    return gram


def _solved(gram: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solutions of the systems; of a singular one, the shortest that fits best."""
    try:
        return np.linalg.solve(gram, right[:, :, None])[:, :, 0]
    except np.linalg.LinAlgError:
        return np.stack([np.linalg.lstsq(g, r, rcond=None)[0] for g, r in zip(gram, right)])


def _solver(rank: int, reg: float, shared: np.ndarray | None):
    upper = tuple(zip(*_pairs(rank)))

    def solve(products: np.ndarray, targets: np.ndarray, counted: np.ndarray) -> np.ndarray:
        gram = np.zeros((len(products), rank, rank))
        gram[:, upper[0], upper[1]] = products
        gram[:, upper[1], upper[0]] = products
        if shared is not None:
            gram += shared
        gram += reg * counted[:, None, None] * np.eye(rank)
        return _solved(gram, targets).astype(np.float32)

    return solve


def _terms(implicit: bool, alpha: float):
    """Weights of the products, targets and counts of ratings."""
    if not implicit:
        return lambda rating: (None, rating, 1)

    def terms(rating: np.ndarray):
        weight = alpha * np.abs(rating)
        return weight, np.where(rating > 0, 1.0 + weight, 0.0), rating > 0

    return terms


def _joined(found: DataFrame, rank: int, solve) -> DataFrame:
    """Vectors of ids whose sums lie in several blocks."""
    width = len(_pairs(rank))
    parts = found.filter("sums is not null").groupBy("id").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.get("sums", F.lit(k))) for k in range(width + rank)]).alias("sums"),
    )

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sums = np.array(batch.column("sums").to_pylist())
            solved = solve(sums[:, :width], sums[:, width:], batch.column("n").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(list(solved), pa.list_(pa.float32()))], ["id", "features"]
            )

    return found.filter("sums is null").select("id", "features").unionByName(parts.mapInArrow(run, FACTOR_SCHEMA))


def _plain(ratings: DataFrame, *ids: str) -> DataFrame:
    """Two long ids and a double; a null rating adds to the sums what 0 does."""
    rating = F.coalesce(F.col("rating").cast("double"), F.lit(0.0)).alias("rating")
    return ratings.select(*[F.col(c).cast("long").alias(c) for c in ids], rating).dropna(subset=list(ids))


def _step(side: factor_blocks.Side, fixed: DataFrame, rank: int, reg: float, implicit: bool, alpha: float) -> DataFrame:
    solve = _solver(rank, reg, _whole_gram(fixed, rank) if implicit else None)
    found = factor_blocks.step(side, fixed, rank, _terms(implicit, alpha), solve)
    if not side.hot:
        return found.select("id", "features")
    return _joined(materialise(found, "als-sums"), rank, solve)


def half_step(
    ratings: DataFrame, fixed: DataFrame, solve_for: str, given: str, rank: int, reg: float,
    implicit: bool = False, alpha: float = 1.0,
) -> DataFrame:
    """Factors of every ``solve_for`` id, given the factors of the ``given`` ids."""
    side = factor_blocks.lay_out(_plain(ratings, solve_for, given), solve_for, given, _width(rank))
    return _step(side, fixed, rank, reg, implicit, alpha)


def _width(rank: int) -> int:
    return len(_pairs(rank)) + rank + 2


def alternate(
    ratings: DataFrame, user: str, item: str, rank: int, iterations: int, reg: float, seed: int,
    implicit: bool = False, alpha: float = 1.0, start: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(user factors, item factors), both (id, features). Each half step is written to the
    shared folder, so neither plans nor lost executors reach back further than one step."""
    ratings = materialise(_plain(ratings, user, item), "als-ratings")
    if start is None:
        start = starting_factors(ratings.select(F.col(user).alias("id")).distinct(), rank, seed)
    users = materialise(start, "als")
    items = users
    sides = [factor_blocks.lay_out(ratings, a, b, _width(rank)) for a, b in ((item, user), (user, item))] if iterations else []
    for _ in range(iterations):
        for side in sides:
            fixed = users if side.given == user else items
            solved = materialise(_step(side, fixed, rank, reg, implicit, alpha), "als")
            if side.solve_for == user:
                users = solved
            else:
                items = solved
    return users, items
