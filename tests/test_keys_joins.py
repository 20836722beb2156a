from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfstream.operators import aggregates, joins, keys, ranking, sampling


def test_dense_ids_equal_row_numbers(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v")).repartition(7)
    got = keys.dense_ids(df, [F.asc("v")]).collect()
    want = {r.v: i for i, r in enumerate(sorted(df.collect()))}
    assert {r.v: r.id for r in got} == want


def test_dense_ids_without_order(spark):
    df = spark.range(1000, numPartitions=5).filter("id % 3 = 0")
    got = keys.dense_ids(df.withColumnRenamed("id", "v")).collect()
    assert sorted(r.id for r in got) == list(range(334))


def test_dense_ids_split_equal_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"))
    got = keys.dense_ids(df, [F.asc("v")], ties=True)
    assert sorted(r.id for r in got.collect()) == list(range(3000))
    values = [r.v for r in sorted(got.collect(), key=lambda r: r.id)]
    assert values == sorted(values)


def test_unique_ids(spark):
    got = keys.unique_ids(spark.range(500, numPartitions=6).withColumnRenamed("id", "v"))
    assert got.columns[0] == "id" and not got.schema["id"].nullable
    assert got.select("id").distinct().count() == 500


def test_frequency_ids(spark):
    labels = ["b"] * 3 + ["a"] * 3 + ["c"] * 5 + ["d"] + [None] * 9
    df = spark.createDataFrame([(x,) for x in labels], "u string")
    got = {r.u: (r.num, r.n) for r in keys.frequency_ids(df, "u", "num").collect()}
    assert got == {"c": (0, 5), "a": (1, 3), "b": (2, 3), "d": (3, 1)}


def test_frequency_ids_match_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.range(400).select((F.col("id") * F.col("id") % 61).cast("string").alias("u"))
    labels = StringIndexer(inputCol="u", outputCol="n").fit(df).labels
    got = keys.frequency_ids(df, "u", "num").orderBy("num").collect()
    assert [r.u for r in got] == labels


def test_text_keys_that_are_no_numbers_match_nothing(spark, rows):
    typed = spark.createDataFrame([(1, "a"), (2, "b")], "id int, n string")
    text = spark.createDataFrame([("1", "x"), ("2x", "y"), (None, "z"), ("", "w")], "id string, v string")
    got = joins.join_text_key(typed, text, "id")
    assert got.columns == ["id", "n", "v"]
    assert rows(got) == [(1, "a", "x")]


def test_reconcile_counts_duplicates_and_nulls(spark, rows):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k int")
    assert rows(joins.reconcile(left, right, "k", ("l", "j"))) == [("j", 4), ("l", 4)]
    empty = left.filter("k > 9")
    assert rows(joins.reconcile(empty, right, "k", ("l", "j"))) == [("j", 0), ("l", 0)]


def test_hot_key_join_and_top_n_are_whole(spark):
    """A third of the rows on one key."""
    many = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    few = spark.range(9000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    assert joins.join_using(many, few, "k").count() == 9000
    best = ranking.top_n_per_group(many, "k", "v", "v", 2)
    assert [r.v for r in best.filter("k = 0").orderBy(F.desc("v")).collect()] == [8997, 8994]
    assert best.count() == 6000 + 2


def test_top_n_is_cut_before_the_shuffle(spark):
    df = ranking.top_n_per_group(spark.range(10).selectExpr("id % 2 k", "id v"), "k", "v", "v", 2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_top_k_ties_and_missing_catalogue_rows(spark, rows):
    scores = spark.createDataFrame([(i, 5) for i in range(12)], "isbn int, n int")
    top = ranking.top_k(scores, "n", "isbn", 10)
    assert [r.isbn for r in top.collect()] == list(range(10))
    books = spark.createDataFrame([(i, f"t{i}") for i in range(5, 20)], "isbn int, title string")
    got = joins.join_few(books, top, "isbn", 10)
    assert got.columns == ["isbn", "n", "title"]
    assert [r[0] for r in rows(got)] == [5, 6, 7, 8, 9]


def test_sampling(spark):
    df = spark.range(20000)
    share = df.filter(sampling.in_share(F.col("id"), 0.3)).count() / 20000
    assert abs(share - 0.3) < 0.02
    assert abs(sampling.bernoulli(df, 0.3, 1).count() / 20000 - 0.3) < 0.02
    for split in (sampling.hash_split(df, F.col("id"), 0.8), sampling.random_split(df, 0.8, 3)):
        one, two = split
        assert one.count() + two.count() == 20000
        assert one.intersect(two).count() == 0
    first = [r.id for r in sampling.shuffled(df, 5).take(50)]
    assert first == [r.id for r in sampling.shuffled(df, 5).take(50)] != sorted(first)


@pytest.mark.parametrize("key", [0, -1, (1 << 62) + 5, -(1 << 63)])
def test_hash_bucket_of_any_key(spark, key):
    bucket = spark.createDataFrame([(key,)], "k bigint").select(
        sampling.hash_bucket(F.col("k"))
    ).first()[0]
    assert bucket == (((key ^ (key >> 31)) % (1 << 31)) * 2654435761) % (1 << 32)


def test_aggregates(spark, rows):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("b", 5.0), ("b", 6.0)], "k string, v double"
    )
    assert rows(aggregates.group_count(df, "k", "v", "n")) == [("a", 1), ("b", 2)]
    for having in (aggregates.group_sum_above, aggregates.group_sum_above_sql):
        assert rows(having(df, "k", "v", 3.0, "s")) == [("b", 11.0)]
    lines = spark.createDataFrame([("x y\nx",), ("",), ("y \n  ",)], "text string")
    counts = rows(aggregates.word_counts(aggregates.lines_of(lines)))
    assert counts == [("", 1), ("x", 2), ("y", 2)]
    profile = aggregates.partition_profile(spark.range(100, numPartitions=4))
    assert Counter(r.rows for r in profile.collect()) == {25: 4}
    scored = df.fillna(0.0).selectExpr("v rating", "1.0 prediction")
    assert abs(aggregates.rmse(scored).first().rmse - ((0 + 1 + 16 + 25) / 4) ** 0.5) < 1e-12
    assert rows(aggregates.union_all([df, df.selectExpr("k z", "v y")])).count(("b", 5.0)) == 2


def test_hot_key_is_split_over_tasks(spark):
    """The many side of a join is read by several tasks at its hot key."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        many = spark.range(300_000, numPartitions=12).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
            F.col("id").alias("v"),
        )
        few = spark.range(300_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        joined = joins.join_using(many, few, "k")
        tasks = joined.groupBy("k", F.spark_partition_id().alias("task")).count()
        assert tasks.filter("k = 0").count() > 1
        assert tasks.agg(F.sum("count")).first()[0] == 300_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_small_shares(spark):
    keys = spark.range(2_000_000)
    n = keys.filter(sampling.in_share(F.col("id"), 1e-5)).count()
    assert 15 <= n <= 25
    large = spark.range(1000).select((F.col("id") * 2**31).alias("id"))
    assert 200 <= large.filter(sampling.in_share(F.col("id"), 0.3)).count() <= 400
    with pytest.raises(ValueError):
        sampling.in_share(F.col("id"), 1e-12)


def test_every_row_of_a_join_is_accounted_for(spark, rows):
    people = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    text = spark.createDataFrame(
        [("1", 10), ("1", 11), ("7", 12), ("2x", 13), (None, 14), ("2x", 15)], "id string, v int"
    )
    got = joins.join_accounted(people, text, "id")
    assert got.columns == ["id", "name", "v", "reject_reason"] and dict(got.dtypes)["id"] == "bigint"
    assert rows(got, "v", "id", "name", "reject_reason") == [
        (10, 1, "a", None), (11, 1, "a", None), (12, 7, None, "unmatched:id"), (13, None, None, "malformed:id"),
        (14, None, None, "malformed:id"), (15, None, None, "malformed:id"),
    ]
    assert joins.join_accounted(people.limit(0), text, "id").filter("reject_reason is null").count() == 0
