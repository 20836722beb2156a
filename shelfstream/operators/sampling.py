"""Sampling, random order and splits, all seeded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# 32-bit multiplicative hashing (the golden-ratio multiplier).
_MULTIPLIER = 2654435761
_BUCKETS = 1 << 32


def bernoulli(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def shuffled(df: DataFrame, seed: int) -> DataFrame:
    """The whole table in random order (a range-partitioned sort on a random column)."""
    return df.orderBy(F.rand(seed))


def random_split(df: DataFrame, share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    first, second = df.randomSplit([share, 1.0 - share], seed)
    return first, second


def hash_bucket(key: Column, seed: int = 0) -> Column:
    """0..2^32-1 from a whole-number key, by a multiplicative hash. The upper bits of the key are
    folded into the lower 31, so the product fits a bigint and no bit is lost sight of."""
    bits = F.lit(1 << 31)
    whole = key.cast("bigint")
    low = F.pmod(whole.bitwiseXOR(F.shiftright(whole, 31)), bits)
    if seed:
        low = F.pmod(low + F.lit(seed % (1 << 31)), bits)
    return F.pmod(low * F.lit(_MULTIPLIER), F.lit(_BUCKETS))


def in_share(key: Column, share: float, seed: int = 0) -> Column:
    """True for about ``share`` of the keys; a row's side never changes between runs."""
    limit = int(share * _BUCKETS)
    if share > 0 and limit == 0:
        raise ValueError(f"a share of {share} is finer than the hash")
    return hash_bucket(key, seed) < F.lit(limit)


def hash_split(
    df: DataFrame, key: Column, share: float, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    inside = in_share(key, share, seed)
    return df.filter(inside), df.filter(~inside)
