import pytest
from pyspark.sql import functions as F, types as T

from shelfstream.functions.widening import wider, widened

LONG, DOUBLE, STRING, NONE = T.LongType(), T.DoubleType(), T.StringType(), T.NullType()


def dec(p, s):
    return T.DecimalType(p, s)


@pytest.mark.parametrize("a, b, want", [
    (LONG, LONG, LONG), (NONE, LONG, LONG), (LONG, dec(2, 1), dec(20, 1)), (dec(3, 2), dec(4, 1), dec(5, 2)),
    (LONG, dec(38, 30), DOUBLE), (LONG, DOUBLE, DOUBLE), (dec(2, 1), DOUBLE, DOUBLE), (DOUBLE, STRING, STRING),
    (T.BooleanType(), LONG, STRING), (T.IntegerType(), LONG, LONG), (T.IntegerType(), dec(5, 2), dec(12, 2)),
    (T.ArrayType(LONG), T.ArrayType(DOUBLE), T.ArrayType(DOUBLE)), (T.ArrayType(LONG), LONG, STRING),
    (T.StructType().add("a", LONG), T.StructType().add("b", STRING).add("a", STRING),
     T.StructType().add("a", STRING).add("b", STRING)),
    (T.MapType(STRING, LONG), T.MapType(STRING, DOUBLE), T.MapType(STRING, DOUBLE)),
])
def test_the_narrowest_type_of_both(a, b, want):
    assert wider(a, b) == want
    assert wider(b, a).simpleString() == want.simpleString() or isinstance(a, T.StructType)
    assert wider(want, a) == want and wider(want, b) == want


def test_casts_keep_values(spark):
    row = spark.sql("select 7L as l, 2.50 as d, array(1L) as a, named_struct('x', 1L) as s, map('k', 1L) as m, cast(null as struct<x:bigint>) as z")
    types = {f.name: f.dataType for f in row.schema.fields}
    wide = T.StructType().add("x", STRING).add("y", LONG)
    got = row.select(
        widened(F.col("l"), LONG, DOUBLE).alias("l"), widened(F.col("d"), types["d"], STRING).alias("d"),
        widened(F.col("a"), types["a"], T.ArrayType(STRING)).alias("a"), widened(F.col("s"), types["s"], wide).alias("s"),
        widened(F.col("s"), types["s"], STRING).alias("j"), widened(F.col("m"), types["m"], T.MapType(STRING, DOUBLE)).alias("m"),
        widened(F.col("z"), types["z"], wide).alias("z"), widened(F.col("l"), NONE, LONG).alias("n"),
    ).first()
    assert (got.l, got.d, got.a, tuple(got.s), got.j, got.m, got.z, got.n) == (
        7.0, "2.50", ["1"], ("1", None), '{"x":1}', {"k": 1.0}, None, None)
