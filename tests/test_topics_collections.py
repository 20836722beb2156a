import pytest
from pyspark.sql import functions as F

from shelfstream.operators.contracts import REASON
from shelfstream.sources import topics
from shelfstream.sources.collections import Collection, merge_documents


def test_messages(spark, rows):
    df = spark.createDataFrame([(7, "a \"q\"\n", 1.5), (8, None, 2.0)], "id int, t string, v double")
    got = rows(topics.to_messages(df, "id"))
    assert got == [
        ("7", '{"id":7,"t":"a \\"q\\"\\n","v":1.5}'), ("8", '{"id":8,"v":2.0}'),
    ]


def test_columns_with_dashes(spark):
    df = spark.createDataFrame([("1", "t")], "ISBN string, `Book-Title` string")
    assert topics.to_messages(df, "ISBN").first().value == '{"ISBN":"1","Book-Title":"t"}'


def test_messages_of_two_publishes_are_told_apart(spark, tmp_path):
    location = str(tmp_path / "topic")
    pairs = [(f"k{i % 9}", f"v{i}") for i in range(60)] + [(None, "n1"), (None, "n2")]
    for part in (pairs, [], pairs):
        assert topics.publish_pairs(spark, part, "t", location=location, partitions=3) is None
    log = topics.read_topic(spark, location)
    assert log.count() == 124
    ids = [r.message_id for r in log.collect()]
    assert len(set(ids)) == 124 and sorted(ids) == sorted(r.message_id for r in log.collect())
    homes = log.filter("key is not null").groupBy("key").agg(F.countDistinct("partition").alias("n"))
    assert homes.filter("n > 1").count() == 0
    assert {r.topic for r in log.select("topic").distinct().collect()} == {"t"}


def test_rejected_rows_lie_beside_the_topic(spark, tmp_path):
    location = str(tmp_path / "topic")
    judged = spark.createDataFrame([("a", "1", None), ("b", "2", "why"), (None, None, "no")], f"key string, value string, {REASON} string")
    first = topics.publish(judged, "t", location=location)
    second = topics.publish(judged.limit(1), "t", location=location)
    assert sorted(map(tuple, first.collect()), key=repr) == [("b", "2", "why"), (None, None, "no")]
    assert second.count() == 0 and topics.read_topic(spark, location).count() == 2
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.publish(judged, "t", fmt="kafka")


def test_explicit_partition_and_peek(spark, tmp_path):
    location = str(tmp_path / "topic")
    messages = spark.createDataFrame(
        [(f"k{i}", f"v{i}", i % 2) for i in range(10)], "key string, value string, partition int"
    ).coalesce(1)
    topics.publish(messages, "t", location=location)
    got = [tuple(r) for r in topics.peek(spark, location, 6).collect()]
    assert got == [(0, f"k{i}", f"v{i}") for i in (0, 2, 4, 6, 8)] + [(1, "k1", "v1")]
    topics.publish(messages.limit(1), "t", location=location)
    assert [r.key for r in topics.peek(spark, location, 6).collect()] == ["k0", "k2", "k4", "k6", "k8", "k0"]
    few = topics.peek(spark, location, 2)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert few.count() == 2 and "(partition#" in plan and "= 0)" in plan
    assert topics.peek(spark, location, 99).count() == 11


def test_broker_format_is_handed_on(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.read_topic(spark, fmt="kafka", subscribe="t").count()
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.publish_pairs(spark, [("a", "b")], "t", fmt="kafka")
    with pytest.raises(Exception, match="(?i)mongodb"):
        Collection(spark, fmt="mongodb").read()


def test_overwrite_replaces_and_gives_ids(spark, tmp_path, rows):
    store = Collection(spark, str(tmp_path / "c"))
    store.overwrite(spark.createDataFrame([(1, ["x"])], "a int, l array<string>"))
    store.overwrite(spark.createDataFrame([(2, ["y"]), (3, None)], "a int, l array<string>"))
    assert store.version() == 2
    assert rows(store.read(), "a", "l") == [(2, ["y"]), (3, None)]
    ids = [r._id.oid for r in store.read().collect()]
    assert len(set(ids)) == 2 and all(len(i) == 24 for i in ids)


def test_unfinished_overwrite_is_not_read(spark, tmp_path, rows):
    store = Collection(spark, str(tmp_path / "c"))
    store.overwrite(spark.createDataFrame([(1,)], "a int"))
    (tmp_path / "c" / "v=000002" / "batch_id=-1").mkdir(parents=True)
    assert store.version() == 1 and rows(store.read(), "a") == [(1,)]
    store.overwrite(spark.createDataFrame([(5,)], "a int"))
    assert store.version() == 2 and rows(store.read(), "a") == [(5,)]


def test_batches_add_up_and_replays_do_not(spark, tmp_path, rows):
    store = Collection(spark, str(tmp_path / "c"))
    one = spark.createDataFrame([(1, None), (2, "bad")], f"a int, {REASON} string")
    two = spark.createDataFrame([(3,)], "a int")
    store.append(one, 0)
    store.append(two, 1)
    store.append(two, 1)
    assert rows(store.read()) == [(1,), (3,)]
    assert [(r.a, r[REASON]) for r in store.rejects().collect()] == [(2, "bad")]


def test_rejects_of_other_stores_need_a_path(spark, tmp_path):
    frame = spark.createDataFrame([(1, None), (2, "bad")], f"a int, {REASON} string")
    rejects = str(tmp_path / "side")
    with pytest.raises(ValueError):
        Collection(spark, fmt="noop").append(frame, 0)
    other = Collection(spark, rejects, fmt="noop")
    other.append(frame, 0)
    assert [r.a for r in other.rejects().collect()] == [2]


def test_merge_field_by_field(spark, tmp_path, rows):
    store = Collection(spark, str(tmp_path / "c"))
    store.overwrite(spark.createDataFrame(
        [(1, "a", 10), (2, "b", 20), (3, None, 30)], "_id int, s string, n int"
    ))
    updates = spark.createDataFrame(
        [(1, "A", None, 1), (3, "C", True, 1), (4, "D", None, 1), (1, None, False, 2), (1, "AA", None, 3)],
        "_id int, s string, flag boolean, seq int",
    )
    store.merge(updates, sequence="seq")
    assert rows(store.read()) == [
        (1, "AA", 10, False), (2, "b", 20, None), (3, "C", 30, True), (4, "D", None, None),
    ]
    again = merge_documents(store.read(), updates.drop("seq"))
    assert again.count() == 4


def files_of(path):
    """(file, time of its last change), without the folder itself."""
    return {(str(f.relative_to(path)), f.stat().st_mtime_ns) for f in path.rglob("*.parquet")}


def test_batches_around_a_merge(spark, tmp_path, rows):
    store = Collection(spark, str(tmp_path / "c"))
    first = spark.createDataFrame([(1, "a"), (2, "b")], "_id int, s string")
    late = spark.createDataFrame([(3, "c", 9)], "_id int, s string, n int")
    store.append(first, 0)
    store.merge(spark.createDataFrame([(1, "A")], "_id int, s string"))
    store.append(late, 1)
    want = [(1, "A", None), (2, "b", None), (3, "c", 9)]
    assert rows(store.read(), "_id", "s", "n") == want
    store.append(first, 0)  # taken in by the merge: a replay changes nothing
    store.append(late, 1)
    assert rows(store.read(), "_id", "s", "n") == want
    store.merge(spark.createDataFrame([(3, "C")], "_id int, s string"))
    store.append(late, 1)
    assert rows(store.read(), "_id", "s", "n") == [*want[:2], (3, "C", 9)]
    store.overwrite(spark.createDataFrame([(7, "x")], "_id int, s string"))
    store.append(late, 1)
    assert rows(store.read()) == [(7, "x")]
    store.append(late, 2)
    assert rows(store.read(), "_id", "n") == [(3, 9), (7, None)]


def test_a_merge_leaves_other_folders_as_they_are(spark, tmp_path, rows):
    store = Collection(spark, str(tmp_path / "c"), buckets=8)
    store.overwrite(spark.range(100).select(F.col("id").alias("_id"), F.lit("old").alias("s")))
    bad = spark.createDataFrame([(200, "old", None), (201, "old", "why")], f"_id bigint, s string, {REASON} string")
    store.append(bad, 0)
    store.append(spark.createDataFrame([(300, "old")], "_id bigint, s string"), 1)
    before = files_of(tmp_path / "c")
    assert len({f.split("/")[1] for f, _ in before}) == 10
    store.merge(spark.createDataFrame([(5, "new", 1), (200, "new", 2), (999, "new", 3)], "_id bigint, s string, n int"))
    same = [f for f, _ in before & files_of(tmp_path / "c")]
    assert len({f.split("/")[1] for f in same}) >= 8 and any("batch_id=1" in f for f in same)
    assert any(f.startswith("v=000001/batch_id=0/row_status=rejected") for f in same)
    got = {r._id: (r.s, r.n) for r in store.read().collect()}
    assert len(got) == 103 and {k for k, v in got.items() if v[0] == "new"} == {5, 200, 999}
    assert got[200] == ("new", 2) and got[300] == ("old", None)
    assert [r._id for r in store.rejects().collect()] == [201] and store.version() == 1
    # the same merge again, as after one that did not end
    store.merge(spark.createDataFrame([(5, "new", 1), (200, "new", 2), (999, "new", 3)], "_id bigint, s string, n int"))
    assert {r._id: (r.s, r.n) for r in store.read().collect()} == got
    # a wider type is a new version
    store.merge(spark.createDataFrame([(5, 2.5)], "_id bigint, n double"))
    assert store.version() == 2
    got = {r._id: (r.s, r.n) for r in store.read().collect()}
    assert got[5] == ("new", 2.5) and got[999] == ("new", 3.0) and len(got) == 103
    store.append(bad, 0)
    assert store.read().count() == 103


def test_a_merge_into_nothing(spark, tmp_path, rows):
    store = Collection(spark, str(tmp_path / "c"))
    store.merge(spark.createDataFrame([(1, "a")], "_id int, s string"))
    assert rows(store.read()) == [(1, "a")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        Collection(spark, str(tmp_path / "d")).read()
