import json

from pyspark.sql import functions as F

from shelfstream import schemas
from shelfstream.functions import nested
from shelfstream.plans import books
from shelfstream.sources import files

RECORD = {name: "x" for name in schemas.RICH_BOOK.names} | {
    "isbn": "0012", "asin": " ", "series": [], "similar_books": ["1", 2],
    "authors": [{"author_id": "71", "role": "editor"}, {"author_id": "72", "role": ""}],
    "popular_shelves": [{"count": "8", "name": "lent out"}, {"count": "-4", "name": "attic"}],
}


def test_rich_book_nested_columns(spark, tmp_path):
    path = tmp_path / "books.json"
    other = RECORD | {"isbn": "9", "series": None, "authors": {"author_id": "5", "role": "r"}}
    path.write_text("\n".join(json.dumps(r) for r in (RECORD, other)))
    raw = files.read_json_text(spark, str(path))
    assert raw.columns == schemas.RICH_BOOK.names
    assert raw.first().series == "[]"
    first, second = books.type_nested(raw).orderBy("isbn").collect()
    assert (first.isbn, first.series, first.similar_books) == ("0012", [], ["1", "2"])
    assert first.popular_shelves[1] == ("-4", "attic")
    assert len(first.authors) == 2
    assert second.series is None
    assert [tuple(a) for a in second.authors] == [("5", "r")]


def test_lost_json(spark):
    df = spark.createDataFrame([('["a"]',), ("[",), ("oops",), (None,)], "t string")
    parsed = nested.typed_json("t", schemas.STRINGS)
    got = [r[0] for r in df.select(nested.lost_json(F.col("t"), parsed)).collect()]
    assert got == [False, True, True, False]


def test_object_ids(spark):
    df = spark.createDataFrame([("5" * 24,), ("XYZ",), (None,)], "t string")
    bad = [r[0] for r in df.select(nested.bad_object_id(F.col("t"))).collect()]
    assert bad == [False, True, True]
    back = df.withColumn("_id", nested.object_id("t")).select(nested.object_id_text("_id"))
    assert back.first()[0] == "5" * 24


def test_message_object_ids_are_unique_and_well_formed(spark):
    df = spark.range(50).select(
        (F.col("id") % 3).cast("int").alias("p"), (F.col("id") * 10**15).alias("o")
    )
    ids = df.select(nested.message_object_id(F.col("p"), F.col("o")).alias("t"))
    assert ids.distinct().count() == 50
    assert ids.filter(nested.bad_object_id(F.col("t"))).count() == 0


def test_nested_access_chain(spark):
    df = spark.sql("select array(named_struct('street', 's1'), named_struct('street', 's2')) as a")
    assert df.select(F.get("a", F.lit(0))["street"]).first()[0] == "s1"
    assert df.select(F.get("a", F.lit(9))["street"]).first()[0] is None
