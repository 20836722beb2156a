"""The driver's tables in the roles of readers, books and ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def score_of_line():
    """A rating 0..10 of a sold line."""
    return (F.col("l_quantity").cast("int") % 11).alias("rating")


def item_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(isbn, rating), straight from the lines."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_partkey").alias("isbn"), F.col("l_quantity").alias("rating"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, isbn, rating, row_key): who ordered which part and how much of it."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("isbn"), score_of_line(),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_key"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("user_id", "isbn", "rating", "row_key")


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("isbn"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("publisher"),
    )


def readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, location, age) as text: one, two or three places in a location."""
    key = F.col("c_custkey")
    location = F.concat(
        F.col("c_mktsegment"),
        F.when(key % 3 > 0, F.concat(F.lit(", "), F.col("c_nationkey").cast("string"))).otherwise(""),
        F.when(key % 3 > 1, F.lit(", X")).otherwise(""),
    )
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("id"),
        location.alias("location"),
        (18 + key % 60).cast("string").alias("age"),
    )


def reader_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, firstname, lastname)."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("firstname"),
        F.col("c_mktsegment").alias("lastname"),
    )
