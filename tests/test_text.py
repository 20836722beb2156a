from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from shelfstream.functions import text


def jvm_split(line: str) -> list[str]:
    """Java's String.split(" "): no match gives the line itself, trailing empties go."""
    parts = line.split(" ")
    if len(parts) == 1:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def words(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    got = df.select("i", text.words_of("value").alias("w")).collect()
    return [r.w for r in sorted(got, key=lambda r: r.i)]


def test_words_edge_cases(spark):
    lines = ["", " ", "   ", "a b", " a", "a ", "a  b", "  a  b  ", "\ta b\t", "a "]
    assert words(spark, lines) == [jvm_split(line) for line in lines]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \t", max_size=12), min_size=40, max_size=80))
def test_words_property(spark, lines):
    assert words(spark, lines) == [jvm_split(line) for line in lines]


def test_null_line_has_no_words(spark):
    df = spark.createDataFrame([(None,)], "value string")
    assert df.select(F.explode(text.words_of("value"))).count() == 0


def test_username_null_and_short(spark):
    df = spark.createDataFrame(
        [("Alexander", "Smithson"), ("Al", "Li"), (None, "Smith"), ("Alexis", "Smithers")],
        "f string, l string",
    )
    got = [r[0] for r in df.select(text.username("f", "l")).collect()]
    assert got == ["alexsmit", "alli", None, "alexsmit"]


def test_location_parts(spark, rows):
    df = spark.createDataFrame(
        [("a",), ("a, b",), ("a, b,c",), ("a,b,c,d",), ("",), (None,)], "location string"
    )
    parts = text.location_parts("location")
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in parts.items()]).collect()]
    assert got == [
        ("a", None, None), ("a", " b", None), ("a", " b", "c"), ("a", "b", "c"),
        ("", None, None), (None, None, None),
    ]
    trimmed = text.location_parts("location", trim=True)
    assert df.select(trimmed["state"]).collect()[1][0] == "b"


def test_to_int(spark):
    df = spark.createDataFrame(
        [("7",), ("-3",), ("5.9",), ("x",), ("",), (None,), ("99999999999",), ("1e3",)], "r string"
    )
    assert [r[0] for r in df.select(text.to_int("r")).collect()] == [
        7, -3, 5, None, None, None, None, None,
    ]


def test_digest_is_one_constant(spark):
    digests = spark.range(5).select(text.salted_digest("password", "salt").alias("d")).distinct()
    assert digests.count() == 1 and len(digests.first().d) == 64
