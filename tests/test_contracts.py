from pyspark.sql import functions as F

from shelfstream.operators import contracts


def judged(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (2, None, 5), (3, None, None), (4, "b", -1)], "k int, city string, age int"
    )
    return contracts.with_reason(
        df, ["city", "age"], [("negative", F.coalesce(F.col("age") < 0, F.lit(False)))]
    )


def test_first_broken_rule_is_the_reason(spark, rows):
    got = rows(judged(spark), "k", contracts.REASON)
    assert got == [(1, None), (2, "null:city"), (3, "null:city"), (4, "negative")]


def test_valid_and_rejected_make_up_the_input(spark, rows):
    df = judged(spark)
    assert contracts.valid_rows(df).count() + contracts.rejected_rows(df).count() == df.count()
    assert rows(contracts.reject_counts(df)) == [("negative", 1), ("null:city", 2)]


def test_split_is_written_in_one_pass(spark, tmp_path):
    path = str(tmp_path / "split")
    marked, seen = contracts.observed_counts(judged(spark))
    contracts.write_split(marked, path)
    assert seen.get == {"messages": 4, "rejected": 3}
    back = spark.read.parquet(path)
    assert back.filter(F.col(contracts.STATUS) == contracts.VALID).count() == 1


def test_no_rules(spark):
    assert contracts.rejected_rows(contracts.with_reason(spark.range(3))).count() == 0
