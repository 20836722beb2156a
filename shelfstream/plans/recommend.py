"""Recommendations from stored ratings: by popularity, and by collaborative filtering."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfstream.operators import factor_blocks
from shelfstream.operators.aggregates import group_count
from shelfstream.operators.factors import alternate, starting_factors
from shelfstream.operators.joins import join_few
from shelfstream.operators.keys import frequency_ids
from shelfstream.sources import paths
from shelfstream.operators.ranking import top_k, top_n_per_group
from shelfstream.operators.top_products import top_products
from shelfstream.session import materialise

USER, ITEM = "user_num", "item_num"
# Training settings.
RANK, ITERATIONS, REG = 10, 5, 0.01
TRIPLET_RANK, TRIPLET_ITERATIONS = 20, 10


def popular_items(
    ratings: DataFrame, books: DataFrame, item: str = "isbn", rating: str = "rating",
    k: int = 10, name: str = "n_ratings",
) -> DataFrame:
    """The ``k`` items with most ratings, with their catalogue rows. Items the catalogue does
    not know are left out after the ranking."""
    top = top_k(group_count(ratings, item, rating, name), name, item, k)
    # the join loses the order of the ranking; k rows are sorted once more
    return join_few(books, top, item, k).orderBy(F.desc(name), item)


# -- numeric ids --------------------------------------------------------------------------


@dataclass(frozen=True)
class Encoded:
    """Ratings with numeric ids, and the mappings that lead back."""

    ratings: DataFrame
    users: DataFrame
    items: DataFrame


def encode(ratings: DataFrame, user: str, item: str) -> Encoded:
    """Number users and items, the most frequent first. The mappings are tables that can be
    stored; rows without a user or item are dropped."""
    users, items = (
        materialise(frequency_ids(ratings, key, number), number)
        for key, number in ((user, USER), (item, ITEM))
    )
    numbered = ratings.join(users.drop("n"), user).join(items.drop("n"), item)
    return Encoded(materialise(numbered, "encoded"), users, items)


def extend(mapping: DataFrame, rows: DataFrame, key: str, number: str) -> DataFrame:
    """A mapping with the keys it lacks numbered behind its last number, the most frequent first; known keys
    keep their numbers and have their counts added up."""
    new = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_more"))
    added = frequency_ids(rows.join(mapping.select(key), key, "left_anti"), key, number)
    last = mapping.agg(F.coalesce(F.max(number) + 1, F.lit(0).cast("bigint")).alias("_start"))
    added = added.crossJoin(F.broadcast(last)).withColumn(number, F.col(number) + F.col("_start")).drop("_start")
    kept = mapping.join(new, key, "left").withColumn("n", F.col("n") + F.coalesce("_more", F.lit(0))).drop("_more")
    return kept.unionByName(added)


def encode_more(known: Encoded, ratings: DataFrame, user: str, item: str) -> Encoded:
    """More ratings under the numbers of earlier ones; new users and items are numbered behind them."""
    users, items = (
        materialise(extend(mapping, ratings, key, number), number)
        for mapping, key, number in ((known.users, user, USER), (known.items, item, ITEM))
    )
    numbered = ratings.join(users.drop("n"), user).join(items.drop("n"), item)
    return Encoded(materialise(numbered, "encoded"), users, items)


# -- training -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Factors:
    """Fitted factors, (id, features) for each side, as tables of their own; ``model`` when
    the caller asked for Spark ML."""

    users: DataFrame
    items: DataFrame
    rank: int
    model: ALSModel | None = None


def fit(
    train: DataFrame, rank: int = RANK, iterations: int = ITERATIONS, reg: float = REG,
    seed: int = 0, implicit: bool = False, alpha: float = 1.0, solver: str = "split",
    start: DataFrame | None = None,
) -> Factors:
    """Train on (user_num, item_num, rating), from user vectors ``start`` where they are given. The half steps
    are joins and aggregations, whatever the size of the data. ``solver="library"`` is for small data: Spark ML
    keeps all ratings of a user or item in one task."""
    if solver == "split":
        users, items = alternate(
            train, USER, ITEM, rank, iterations, reg, seed, implicit, alpha, start
        )
        return Factors(users, items, rank)
    if solver != "library":
        raise ValueError(f"no solver {solver}")
    model = ALS(
        rank=rank, maxIter=iterations, regParam=reg, seed=seed, implicitPrefs=implicit,
        alpha=alpha, userCol=USER, itemCol=ITEM, ratingCol="rating", coldStartStrategy="drop",
    ).fit(train)
    users = materialise(model.userFactors, "user-factors")
    items = materialise(model.itemFactors, "item-factors")
    return Factors(users, items, rank, model)


def fit_triplets(triplets: DataFrame, seed: int = 0) -> Factors:
    """Train on (user, item, rating) rows with the settings for such files."""
    train = triplets.filter(F.col("user").isNotNull() & F.col("item").isNotNull()).select(
        F.col("user").alias(USER), F.col("item").alias(ITEM), "rating"
    )
    return fit(train, TRIPLET_RANK, TRIPLET_ITERATIONS, REG, seed)


def start_from(factors: Factors, encoded: Encoded, seed: int = 0) -> DataFrame:
    """User vectors to go on training with: fitted ones, and starting ones for users numbered since."""
    ids = encoded.users.select(F.col(USER).cast("long").alias("id"))
    new = ids.join(factors.users.select("id"), "id", "left_anti")
    return factors.users.unionByName(starting_factors(new, factors.rank, seed))


# -- storing ------------------------------------------------------------------------------


def save(path: str, encoded: Encoded, factors: Factors) -> None:
    """Write mappings and factors, each as a table under ``path``; a mark at the end tells that all are there."""
    spark = encoded.users.sparkSession
    paths.remove(spark, f"{path}/rank")
    tables = {
        "ratings": encoded.ratings, "users": encoded.users, "items": encoded.items,
        "user_factors": factors.users, "item_factors": factors.items,
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    paths.put_text(spark, f"{path}/rank", str(factors.rank))


def load(spark: SparkSession, path: str) -> tuple[Encoded, Factors]:
    rank = paths.get_text(spark, f"{path}/rank")
    if rank is None:
        raise ValueError(f"{path} holds no complete model")
    ratings, users, items, user_factors, item_factors = (
        spark.read.parquet(f"{path}/{name}")
        for name in ("ratings", "users", "items", "user_factors", "item_factors")
    )
    return Encoded(ratings, users, items), Factors(user_factors, item_factors, int(rank))


# -- scoring ------------------------------------------------------------------------------


def _dot(left: str, right: str, rank: int):
    products = [
        F.get(left, F.lit(i)).cast("double") * F.get(right, F.lit(i)).cast("double")
        for i in range(rank)
    ]
    return reduce(add, products).cast("float")


def score(factors: Factors, rows: DataFrame) -> DataFrame:
    """Add ``prediction``; rows of users or items never trained on are dropped. Rows of nothing but two ids and a
    rating are packed, so that vectors are sent once per block and not once per row."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    if set(kinds) == {USER, ITEM, "rating"} and kinds["rating"] in ("int", "double") and {kinds[USER], kinds[ITEM]} <= {"int", "bigint"}:
        narrow = rows.select(
            *[F.col(c).cast("long").alias(c) for c in (USER, ITEM)], F.col("rating").cast("double").alias("rating")
        ).dropna()
        packed = factor_blocks.products(narrow, factors.users, factors.items, USER, ITEM, factors.rank)
        packed = packed.select(*[F.col(c).cast(kinds[c]).alias(c) for c in rows.columns], "prediction")
        unrated = rows.filter("rating is null")
        return packed if unrated.isEmpty() else packed.unionByName(_joined_scores(factors, unrated))
    return _joined_scores(factors, rows)


def _joined_scores(factors: Factors, rows: DataFrame) -> DataFrame:
    users = factors.users.select(F.col("id").alias(USER), F.col("features").alias("_u"))
    items = factors.items.select(F.col("id").alias(ITEM), F.col("features").alias("_i"))
    return (
        rows.join(users, USER).join(items, ITEM)
        .withColumn("prediction", _dot("_u", "_i", factors.rank))
        .select(*rows.columns, "prediction")
    )


def known_rows(test: DataFrame, train: DataFrame) -> DataFrame:
    """Rows of ``test`` whose user and item both occur in ``train``."""
    for c in (USER, ITEM):
        if c in test.columns:
            test = test.join(train.select(c).distinct(), c, "left_semi")
    return test


# -- recommending -------------------------------------------------------------------------


def recommend(factors: Factors, asked: Iterable[int], n: int = 3, by: str = USER) -> DataFrame:
    """The ``n`` best items of each asked user, or with ``by=ITEM`` the best users of each
    item: (user_num, item_num, rating). Items already rated stay in.

    ``asked`` is the caller's own list, so the driver holds no more than it was given. The vectors
    travel inside the plan; the other side is read once and cut to ``n`` rows per asked one in
    every task."""
    this, other, of = (
        (factors.users, factors.items, ITEM) if by == USER else (factors.items, factors.users, USER)
    )
    few = this.filter(F.col("id").isin([int(x) for x in asked])).collect()
    vectors = F.from_json(
        F.lit(json.dumps([{"id": r.id, "features": [float(x) for x in r.features]} for r in few])),
        "array<struct<id:bigint,features:array<float>>>",
    )
    scored = other.select(
        F.col("id").alias(of), "features", F.explode(vectors).alias("_a")
    ).select(
        F.col("_a.id").alias(by), of, _dot("features", "_a.features", factors.rank).alias("rating")
    )
    return top_n_per_group(scored, by, "rating", of, n)


def recommend_all(factors: Factors, n: int = 3, by: str = USER) -> DataFrame:
    """The ``n`` best items of every user, or with ``by=ITEM`` the best users of every item: (user_num, item_num,
    rating). Exact; searches end early by the lengths of the vectors (``operators.top_products``)."""
    this, other, of = (
        (factors.users, factors.items, ITEM) if by == USER else (factors.items, factors.users, USER)
    )
    found = top_products(this, other, n)
    return found.select(F.col("asking").alias(by), F.col("id").alias(of), F.col("product").cast("float").alias("rating"))


def decode(recommended: DataFrame, encoded: Encoded) -> DataFrame:
    """Numeric ids back to the ids the ratings came with."""
    return (
        recommended.join(encoded.users.drop("n"), USER)
        .join(encoded.items.drop("n"), ITEM)
        .drop(USER, ITEM)
    )
