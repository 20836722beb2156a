import json

import pytest
from pyspark.sql import functions as F, types as T

from shelfstream import schemas
from shelfstream.operators import aggregates
from shelfstream.operators.contracts import REASON
from shelfstream.plans import books, ratings, readers
from shelfstream.sources import topics
from shelfstream.sources.collections import Collection
from shelfstream.streaming import load, words

DOC = T.StructType([T.StructField("a", T.LongType()), T.StructField("value", T.StringType())])


class Setup:
    def __init__(self, spark, base):
        self.spark, self.base = spark, base
        self.location = str(base / "topic")
        self.checkpoint = str(base / "checkpoint")
        self.metrics = str(base / "metrics")
        self.store = Collection(spark, str(base / "store"))

    def send(self, *docs):
        texts = [d if isinstance(d, str) or d is None else json.dumps(d) for d in docs]
        topics.publish_pairs(self.spark, [("k", t) for t in texts], "t", location=self.location)

    def load(self, prepare=None, **options):
        stream = topics.stream_topic(self.spark, self.location, **options)
        return load.run_load(
            stream, prepare or load.declared(DOC), self.store, self.checkpoint,
            metrics=self.metrics, keep=prepare is not None,
        )


@pytest.fixture
def job(spark, tmp_path):
    return Setup(spark, tmp_path)


def test_stream_equals_batch(job, rows):
    for start in (0, 10, 20):
        job.send(*[{"a": i, "value": f"v{i}"} for i in range(start, start + 10)])
    job.load(maxFilesPerTrigger="1")
    batch = load.declared(DOC)(topics.read_topic(job.spark, job.location), 0)
    assert rows(job.store.read().drop("rest")) == rows(batch.drop(REASON, "raw_message", "rest"))
    assert job.store.read().select("_id.oid").distinct().count() == 30


def test_restart_adds_only_what_is_new(job, rows):
    job.send({"a": 1}, {"a": 2})
    job.load()
    job.load()
    job.send({"a": 3})
    job.load()
    assert rows(job.store.read(), "a") == [(1,), (2,), (3,)]
    counts = load.read_metrics(job.spark, job.metrics)
    assert rows(counts, "batch_id", "messages") == [(0, 2), (1, 1)]


def test_a_replayed_batch_is_replaced(job, rows):
    job.send({"a": 1}, {"a": 2})
    job.load()
    (job.base / "checkpoint" / "commits" / "0").unlink()
    (job.base / "checkpoint" / "commits" / ".0.crc").unlink(missing_ok=True)
    before = rows(job.store.read().drop("rest"))
    job.load()
    assert rows(job.store.read().drop("rest")) == before and len(before) == 2


def test_another_checkpoint_is_refused(job):
    job.send({"a": 1})
    job.load()
    job.checkpoint = str(job.base / "elsewhere")
    with pytest.raises(ValueError, match="another checkpoint"):
        job.load()


def test_load_after_overwrite_and_overwrite_after_load(job, rows):
    old = job.spark.createDataFrame([(9, "x")], "a bigint, value string")
    job.store.overwrite(old)
    job.send({"a": 1})
    job.load()
    assert rows(job.store.read(), "a") == [(1,), (9,)]
    job.store.overwrite(old)
    job.send({"a": 2})
    job.load()
    assert rows(job.store.read(), "a") == [(2,), (9,)]


def test_bad_messages_are_rejected_with_their_text(job):
    job.send({"a": 1, "value": "x"}, "{cut", None, {"a": "text"}, {"value": "y"})
    job.load(load.declared(DOC, not_null=["a"]))
    assert [r.a for r in job.store.read().collect()] == [1]
    reasons = {r.raw_message: r[REASON] for r in job.store.rejects().collect()}
    assert reasons == {
        "{cut": "malformed", None: "null:value", '{"a": "text"}': "malformed",
        '{"value": "y"}': "null:a",
    }
    counts = load.read_metrics(job.spark, job.metrics).first()
    assert (counts.messages, counts.rejected) == (5, 4)


def test_empty_topic_writes_nothing(job):
    job.send()
    job.load()
    assert not job.store.has_batches()


def test_undeclared_fields_come_back(job):
    job.send({"a": 1, "zz": 5, "deep": {"l": [1, "x"]}}, {"a": 2}, {"a": 3, "A": None}, '{"a":4,"a":5,"zz":1}', '{"a":6,"a":7}', "[1]")
    job.load()
    got = {r.a: r.rest for r in job.store.read().select("a", F.to_json("rest").alias("rest")).collect()}
    assert got == {1: '{"deep":{"l":[1,"x"]},"zz":5}', 2: None, 3: '{"A":null}', 7: None}
    numbers = job.store.read().select(F.variant_get("rest", "$.zz", "int").alias("zz")).filter("zz is not null")
    assert [r.zz for r in numbers.collect()] == [5]
    reasons = {r.raw_message: r[REASON] for r in job.store.rejects().collect()}
    assert reasons == {'{"a":4,"a":5,"zz":1}': "name:twice", "[1]": "malformed"}
    counts = load.read_metrics(job.spark, job.metrics).first()
    assert (counts.messages, counts.rejected, counts.undeclared) == (6, 2, 2)


def test_drifting_fields(job, rows):
    prepare = load.drifting(job.store)
    job.send({"a": 1, "b": "x", "n": None}, {"a": 2})
    job.load(prepare)
    job.send({"a": 3, "c": [1]}, {"a": 4.5}, {"a": None, "b": 7, "n": None})
    job.load(prepare)
    got = rows(job.store.read(), F.col("a").cast("double"), "b", "c", "n")
    assert got == [
        (1.0, "x", None, None), (2.0, None, None, None), (3.0, None, [1], None), (4.5, None, None, None),
        (None, "7", None, None),
    ]
    assert job.store.rejects().count() == 0 and dict(job.store.read().dtypes)["n"] == "string"
    job.send({"a": 2**60, "n": 3}, '{"a":1e300}', {"c": [{"x": 1}]}, {"c": "t", "n": 4})
    job.load(prepare)
    kinds = dict(job.store.read().dtypes)
    assert (kinds["a"], kinds["c"], kinds["n"]) == ("double", "string", "bigint")
    assert rows(job.store.read().filter("c is not null"), "c") == [('[1]',), ('[{"x":1}]',), ("t",)]
    assert job.store.read().filter("a = 1e300 or a = 4.5").count() == 2


def test_a_replay_of_a_widened_batch_is_the_same(job, rows):
    prepare = load.drifting(job.store)
    for sent in ({"a": 1}, {"a": 2.5}, {"a": "t"}):
        job.send(sent)
        job.load(prepare)
    want = [("1",), ("2.5",), ("t",)]
    assert rows(job.store.read(), "a") == want
    files = {f: f.stat().st_mtime_ns for f in (job.base / "store").rglob("batch_id=[01]/**/*.parquet")}
    (job.base / "checkpoint" / "commits" / "2").unlink()
    (job.base / "checkpoint" / "commits" / ".2.crc").unlink(missing_ok=True)
    job.load(prepare)
    assert rows(job.store.read(), "a") == want and job.store.schema_before(2) != job.store.schema_before(3)
    assert files == {f: f.stat().st_mtime_ns for f in (job.base / "store").rglob("batch_id=[01]/**/*.parquet")}


def test_drifting_names_that_clash(job, rows):
    prepare = load.drifting(job.store)
    job.send({"a": 1, "value": "x"}, {"a": 3, "batch_id": 7}, {"it's": 1, "a": 4})
    job.load(prepare)
    job.send({"a": 5, "VALUE": "y"}, {"a": 6, "value": "z"}, {"A": 2})
    job.load(prepare)
    assert rows(job.store.read(), "a", "value") == [(1, "x"), (4, None), (6, "z")]
    reasons = sorted(r[REASON] for r in job.store.rejects().collect())
    assert reasons == ["name:A", "name:VALUE", "name:batch_id"]
    with pytest.raises(ValueError, match="batch_id"):
        load.typed_documents(
            topics.read_topic(job.spark, job.location),
            T.StructType([T.StructField("batch_id", T.LongType())]),
        )


def test_live_load_stops_after_a_while(job, rows):
    job.send({"a": 1})
    stream = topics.stream_topic(job.spark, job.location)
    query = load.run_load(
        stream, load.declared(DOC), job.store, job.checkpoint,
        trigger=load.LIVE_TRIGGER, wait=False,
    )
    query.processAllAvailable()
    load.run_for(query, 0.5)
    assert not query.isActive
    assert rows(job.store.read(), "a") == [(1,)]


def test_word_counts_are_per_batch(spark, tmp_path, rows):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    lines = ["a b a", "", " ", "b  c "]
    for i in range(2):
        (inbox / f"f{i}.txt").write_text("\n".join(lines) + "\n")
    stream = topics.stream_lines(spark, str(inbox), maxFilesPerTrigger="1")
    words.run_word_count(stream, out, str(tmp_path / "cp"), show=True)
    counts = spark.read.parquet(out)
    want = rows(aggregates.word_counts(spark.createDataFrame([(x,) for x in lines], "value string")))
    for batch in (0, 1):
        assert rows(counts.filter(F.col("batch_id") == batch), "word", "n") == want


def test_tumbling_counts_edges(spark):
    events = spark.sql(
        "select * from values (timestamp_ntz'2024-01-01 00:00:00.999', 'x'),"
        "(timestamp_ntz'2024-01-01 00:00:01', 'x'), (timestamp_ntz'2024-01-01 00:00:01.5', 'x') t(ts, k)"
    )
    got = words.tumbling_counts(events, "ts", "k").orderBy("window_start").collect()
    assert [r.n for r in got] == [1, 2]


def test_windows_of_a_stream_close_by_the_watermark(spark, tmp_path, rows):
    inbox, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))

    def run(*events):
        spark.createDataFrame(events, "t string, k string").select(
            F.to_timestamp("t").alias("ts"), "k").write.mode("append").parquet(inbox)
        stream = spark.readStream.schema("ts timestamp, k string").parquet(inbox)
        return words.run_tumbling_counts(stream, "ts", "k", out, cp, late="5 seconds")

    day = "2024-01-01 00:00:"
    assert run((day + "01.2", "x"), (day + "01.9", "x"), (day + "04", "y")) == 0
    assert spark.read.schema("n long").parquet(out).count() == 0  # nothing is final yet
    assert run((day + "01.5", "x"), (day + "20", "x")) == 0  # late, but in time
    assert rows(spark.read.parquet(out), "k", "n") == [("x", 3), ("y", 1)]
    assert run((day + "01.5", "x"), (day + "14", "x"), (day + "19", "y")) == 2
    assert run((day + "40", "z")) == 0
    assert rows(spark.read.parquet(out), "k", "n") == [("x", 1), ("x", 3), ("y", 1), ("y", 1)]
    with pytest.raises(ValueError, match="late"):
        words.tumbling_counts(spark.readStream.schema("ts timestamp, k string").parquet(inbox), "ts", "k")


def test_the_whole_chain(spark, tmp_path, rows):
    """Files to readers to ratings, with every bad row accounted for."""
    (tmp_path / "users.csv").write_text(
        "id;location;age\n1;a, b, c;18\n2;a;20\n3;x, y, z, w;\nbad;a, b, c;9\n4;q, r, s;NULL\n"
    )
    names = spark.createDataFrame(
        [(1, "Alexander", "Smithson"), (2, "Bo", "Li"), (3, "Cy", "Do"), (4, None, "Ng"), (5, "E", "F")],
        "id int, firstname string, lastname string",
    )
    from shelfstream.sources.files import read_delimited

    users = read_delimited(spark, str(tmp_path / "users.csv"), schemas.READER)
    enriched = readers.enrich_names(names, "password", "salt")
    rejected = readers.publish_readers(enriched, users, "u", location=str(tmp_path / "u"))
    assert rows(rejected, "usernum", REASON) == [
        (2, "null:state"), (3, "null:age"), (4, "null:firstname"), (None, "malformed:id"),
    ]
    people = Collection(spark, str(tmp_path / "people"))
    load.run_load(
        topics.stream_topic(spark, str(tmp_path / "u")), readers.reader_documents(), people,
        str(tmp_path / "cp1"),
    )
    assert rows(people.read(), "usernum", "username", "state") == [(1, "alexsmit", " b")]

    rated = spark.createDataFrame(
        [("1", "012X", "5"), ("1", "012X", "5"), ("1", "9", "x"), ("1", "9", None), ("77", "9", "1"),
         ("bad", "9", "1")], schemas.RATING,
    )
    rejected = ratings.publish_ratings(people.read(), rated, "r", location=str(tmp_path / "r"))
    assert sorted(r[REASON] for r in rejected.collect()) == [
        "malformed:usernum", "null:rating", "null:rating", "unmatched:usernum",
    ]
    stored = Collection(spark, str(tmp_path / "rated"))
    load.run_load(
        topics.stream_topic(spark, str(tmp_path / "r")), ratings.rating_documents(), stored,
        str(tmp_path / "cp2"),
    )
    got = stored.read().collect()
    assert [(r.ISBN, r.rating, r.firstname) for r in got] == [("012X", 5, "Alexander")] * 2
    oid = people.read().first()._id.oid
    assert all(r.userId == oid == r.uid.oid for r in got)


def test_rich_books_with_bad_nested_text(spark, tmp_path):
    plain = {n: "" for n in schemas.RICH_BOOK.names}
    nested = {"series": "[]", "similar_books": '["1"]', "authors": "[]", "popular_shelves": "[]"}
    good, bad = plain | nested | {"isbn": "1"}, plain | nested | {"isbn": "2", "series": "[oops"}
    topics.publish_pairs(
        spark, [(b["isbn"], json.dumps(b)) for b in (good, bad)], "t", location=str(tmp_path / "t")
    )
    store = Collection(spark, str(tmp_path / "s"))
    load.run_load(
        topics.stream_topic(spark, str(tmp_path / "t")), books.rich_book_documents(), store,
        str(tmp_path / "cp"),
    )
    (kept,) = store.read().collect()
    assert (kept.isbn, kept.series, kept.similar_books) == ("1", [], ["1"])
    assert [r[REASON] for r in store.rejects().collect()] == ["nested:series"]


def test_books_under_the_names_of_their_own_header(job, rows, tmp_path):
    """An inferred file with dashed names, kept as text where it is a key, loaded by drift."""
    from shelfstream.sources.files import read_inferred

    path = tmp_path / "books.csv"
    path.write_text(
        '"ISBN";"Book-Title";"Year.Of";"Image-URL-S"\n'
        '"0195153448";"A ""quoted"" title; or two";2002;"http://x"\n"000201";"B";1999;"http://y"\n'
    )
    found = read_inferred(job.spark, str(path), sep=";", text_columns=("ISBN",), escape='"')
    rejected = books.publish_books(found, "books", location=job.location)
    assert rejected.count() == 0
    job.load(load.drifting(job.store))
    kept = books.catalogue(job.store.read()).drop("_id")
    assert kept.columns == ["Book-Title", "ISBN", "Year.Of"]
    assert rows(kept) == [
        ('A "quoted" title; or two', "0195153448", 2002), ("B", "000201", 1999),
    ]
