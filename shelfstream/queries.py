"""Every query on the driver's tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from shelfstream import schemas
from shelfstream.functions.nested import bad_object_id, object_id, typed_json
from shelfstream.functions.text import location_parts, to_int
from shelfstream.operators import aggregates, contracts, filters, joins, keys, ranking, sampling
from shelfstream.plans import books as book_plans
from shelfstream.plans import names as name_plans
from shelfstream.plans import ratings as rating_plans
from shelfstream.plans import readers as reader_plans
from shelfstream.plans import recommend
from shelfstream.plans import tables as t
from shelfstream.session import fresh_path, materialise
from shelfstream.sources import files, topics
from shelfstream.sources.collections import Collection
from shelfstream.sources.json_text import read_json_column
from shelfstream.streaming import load, words

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[fn.__name__] = fn
        if sql:
            _SQL[fn.__name__] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# -- sources and sinks --------------------------------------------------------------------


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id,
  c_mktsegment || CASE WHEN c_custkey % 3 > 0 THEN ', ' || c_nationkey ELSE '' END
    || CASE WHEN c_custkey % 3 > 1 THEN ', X' ELSE '' END AS location,
  CAST(18 + c_custkey % 60 AS VARCHAR) AS age FROM customer""")
def src_delimited(spark, sf_dir):
    path = fresh_path(spark, "delimited")
    t.readers(spark, sf_dir).write.csv(path, sep=";", header=True)
    return files.read_delimited(spark, path, schemas.READER)


@query("""SELECT c_custkey AS id, c_acctbal AS balance, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS code
FROM customer""")
def src_inferred(spark, sf_dir):
    path = fresh_path(spark, "inferred")
    rows = t.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"),
        F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("code"),
    )
    rows.write.csv(path, header=True)
    read = files.read_inferred(spark, path, text_columns=("code",))
    return read.withColumn("id", F.col("id").cast("bigint"))


@query("""SELECT CAST(p_partkey AS VARCHAR) AS isbn, p_name AS title,
  '["' || p_brand || '","' || p_type || '"]' AS series FROM part""")
def src_json_raw(spark, sf_dir):
    path = fresh_path(spark, "json")
    t.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("isbn"), F.col("p_name").alias("title"),
        F.array("p_brand", "p_type").alias("series"),
    ).write.json(path)
    return files.read_json_text(spark, path, schemas.all_strings("isbn", "title", "series"))


@query("""SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_orderkey AS INT) END AS "user",
  CAST(l_partkey AS INT) AS item, CAST(CAST(l_quantity AS INT) % 11 AS DOUBLE) AS rating FROM lineitem""")
def src_triplets(spark, sf_dir):
    path = fresh_path(spark, "triplets")
    lines = t.table(spark, sf_dir, "lineitem")
    user = F.col("l_orderkey").cast("string")
    lines.select(
        F.when(F.col("l_linenumber") == 7, F.concat(user, F.lit("X"))).otherwise(user),
        "l_partkey", t.score_of_line(),
    ).write.csv(path)
    return files.read_triplets(spark, path).drop(files.CORRUPT)


@query("""SELECT c_custkey AS id, c_name AS name,
  CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS segment FROM customer""")
def json_infer(spark, sf_dir):
    texts = t.table(spark, sf_dir, "customer").select(F.to_json(F.struct(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 2 == 1, F.col("c_mktsegment")).alias("segment"),
    )).alias("value"))
    return read_json_column(texts)


@query("""SELECT CAST(p_partkey AS VARCHAR) AS "key",
  CAST(to_json({'p_partkey': p_partkey, 'p_name': p_name, 'p_brand': p_brand}) AS VARCHAR) AS "value"
FROM part""")
def publish_messages(spark, sf_dir):
    location = fresh_path(spark, "topic")
    parts = t.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    rejected = reader_plans.publish_rows(parts, "p_partkey", "books", location=location)
    sent = topics.read_topic(spark, location).select("key", "value")
    return sent.unionByName(rejected.select(F.col("p_partkey").cast("string").alias("key"),
                                            F.col(contracts.REASON).alias("value")))


@query("""SELECT CAST(o_orderkey % 4 AS INT) AS "partition", CAST(o_orderkey AS VARCHAR) AS "key",
  o_orderpriority AS "value" FROM orders ORDER BY 1, o_orderkey LIMIT 100""")
def topic_peek(spark, sf_dir):
    location = fresh_path(spark, "topic")
    orders = t.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderpriority").alias("value"),
        (F.col("o_orderkey") % 4).cast("int").alias("partition"),
    )
    topics.publish(orders, "orders", location=location)
    return topics.peek(spark, location, 100)


@query("""SELECT CAST(p_partkey % 4 AS INT) AS "partition", COUNT(*) AS n, COUNT(DISTINCT p_partkey) AS offsets
FROM part GROUP BY 1""")
def topic_offsets(spark, sf_dir):
    """Two publishes to one topic with partitions of their own choice: every message is told apart."""
    location = fresh_path(spark, "topic")
    parts = t.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("key"), F.col("p_name").alias("value"),
        (F.col("p_partkey") % 4).cast("int").alias("partition"),
    )
    small = F.col("key").cast("bigint") % 3 == 0
    topics.publish(parts.filter(small), "books", location=location)
    topics.publish(parts.filter(~small), "books", location=location)
    return topics.read_topic(spark, location).groupBy("partition").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("message_id").alias("offsets")
    )


@query("""SELECT c_custkey AS id, c_mktsegment AS firstname, c_name AS lastname FROM customer""")
def names_export(spark, sf_dir):
    path = fresh_path(spark, "names")
    names = t.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("firstname"),
        F.col("c_name").alias("lastname"),
    )
    name_plans.export_names(names, path)
    return files.read_delimited(spark, path, schemas.NAME, sep=",", escape='"')


@query("""SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer""")
def docstore_roundtrip(spark, sf_dir):
    store = Collection(spark, fresh_path(spark, "collection"))
    people = t.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    store.overwrite(people.withColumn("segment", F.lit("old")))
    store.overwrite(people)
    return store.read().drop("_id")


@query("""SELECT c_custkey AS _id, CASE WHEN c_custkey % 3 = 0 THEN 'NEW' ELSE c_mktsegment END AS segment,
  c_nationkey AS nation FROM customer""")
def docstore_merge(spark, sf_dir):
    store = Collection(spark, fresh_path(spark, "collection"))
    people = t.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("_id"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
    )
    store.overwrite(people)
    store.merge(people.filter(F.col("_id") % 3 == 0).select("_id", F.lit("NEW").alias("segment")))
    return store.read()


@query("""SELECT COUNT(*) AS n, COUNT(DISTINCT c_custkey) AS ids, SUM(CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END)::BIGINT AS merged
FROM customer""")
def docstore_replay_after_merge(spark, sf_dir):
    """Batch 0 comes again after a merge that folded it, batch 1 for the first time."""
    store = Collection(spark, fresh_path(spark, "collection"))
    people = t.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("_id"), F.lit("old").alias("state"))
    first = people.filter(F.col("_id") % 2 == 0)
    store.append(first, 0)
    store.merge(people.filter(F.col("_id") % 3 == 0).select("_id", F.lit("new").alias("state")))
    store.append(first, 0)
    store.append(people.filter((F.col("_id") % 2 == 1) & (F.col("_id") % 3 != 0)), 1)
    return store.read().agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("_id").alias("ids"), F.count_if(F.col("state") == "new").alias("merged")
    )


@query("SELECT COUNT(*) AS n, COUNT(*) AS ids FROM customer")
def docstore_load_after_overwrite(spark, sf_dir):
    """Half the documents by an overwrite, the others by a load of messages: no id is given twice."""
    store, location = Collection(spark, fresh_path(spark, "collection")), fresh_path(spark, "topic")
    people = t.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    odd = F.col("id") % 2 == 1
    store.overwrite(people.filter(odd))
    topics.publish(topics.to_messages(people.filter(~odd), "id"), "people", location=location)
    load.run_load(topics.stream_topic(spark, location), load.declared(people.schema), store, fresh_path(spark, "checkpoint"))
    return store.read().agg(F.count(F.lit(1)).alias("n"), F.countDistinct("_id").alias("ids"))


# -- projections, contracts, filters ------------------------------------------------------


@query("""SELECT c_custkey AS id, lower(substring(c_name, 1, 4)) || lower(substring(c_mktsegment, 1, 4)) AS username,
  sha256('salt' || 'password') AS password FROM customer""")
def enrich_users(spark, sf_dir):
    named = reader_plans.enrich_names(t.reader_names(spark, sf_dir), "password", "salt")
    return named.select("id", "username", "password")


@query("""SELECT c_custkey AS id, string_split(l, ',')[1] AS city, string_split(l, ',')[2] AS state,
  string_split(l, ',')[3] AS country
FROM (SELECT c_custkey, c_mktsegment || CASE WHEN c_custkey % 3 > 0 THEN ', ' || c_nationkey ELSE '' END
  || CASE WHEN c_custkey % 3 > 1 THEN ', X' ELSE '' END AS l FROM customer)""")
def parse_location(spark, sf_dir):
    parts = location_parts("location")
    return t.readers(spark, sf_dir).select(
        F.col("id").cast("bigint").alias("id"), *[c.alias(name) for name, c in parts.items()]
    )


@query("""SELECT o_orderkey AS id, TRY_CAST(substring(o_orderpriority, 1, 1 + o_orderkey % 2) AS INT) AS rating
FROM orders""")
def cast_rating(spark, sf_dir):
    text = F.substring(
        F.col("o_orderpriority"), F.lit(1), (1 + F.col("o_orderkey") % 2).cast("int")
    )
    return t.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), to_int(text).alias("rating")
    )


@query("""SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'null:city' WHEN o_orderkey % 13 = 0 THEN 'null:age' END AS reason,
  COUNT(*) AS n FROM orders WHERE o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 GROUP BY 1""")
def reject_rows(spark, sf_dir):
    key = F.col("o_orderkey")
    rows = t.table(spark, sf_dir, "orders").select(
        key,
        F.when(key % 11 != 0, F.col("o_orderstatus")).alias("city"),
        F.when(key % 13 != 0, F.col("o_orderpriority")).alias("age"),
    )
    judged = contracts.with_reason(rows, not_null=["city", "age"])
    return contracts.reject_counts(judged).withColumnRenamed(contracts.REASON, "reason")


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  [event_type, CAST(user_id AS VARCHAR)] AS series, event_type AS shelf FROM events""")
def parse_nested(spark, sf_dir):
    events = t.table(spark, sf_dir, "events")
    as_text = events.select(
        "event_id", "props",
        F.to_json(F.array("event_type", F.col("user_id").cast("string"))).alias("series"),
        F.to_json(F.array(F.struct(
            F.lit("1").alias("count"), F.col("event_type").alias("name"),
        ))).alias("popular_shelves"),
    )
    typed = book_plans.type_nested(
        as_text, {"series": schemas.STRINGS, "popular_shelves": schemas.SHELVES}
    )
    return typed.select(
        "event_id",
        typed_json("props", T.StructType([T.StructField("k", T.LongType())]))["k"].alias("k"),
        "series",
        F.get("popular_shelves", F.lit(0))["name"].alias("shelf"),
    )


@query("""SELECT lpad(lower(to_hex(c_custkey)), 24, '0') AS user_id,
  lpad(lower(to_hex(c_custkey)), 24, '0') AS oid, c_custkey < 0 AS bad FROM customer""")
def attach_object_id(spark, sf_dir):
    ids = t.table(spark, sf_dir, "customer").select(
        F.lpad(F.lower(F.hex("c_custkey")), 24, "0").alias("user_id")
    )
    return ids.withColumn("uid", object_id("user_id")).select(
        "user_id", F.col("uid.oid").alias("oid"), bad_object_id(F.col("user_id")).alias("bad")
    )


@query("""SELECT p_partkey AS isbn, p_name AS title FROM part WHERE regexp_matches(p_name, '^red')""")
def regex_filter(spark, sf_dir):
    return filters.starts_with(t.books(spark, sf_dir), "title", "red").select("isbn", "title")


@query("""SELECT o_orderkey AS id FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-02-01'""")
def date_range_filter(spark, sf_dir):
    day = "timestamp_ntz'{} 00:00:00'"
    found = filters.in_range(
        t.table(spark, sf_dir, "orders"), "o_orderdate",
        F.expr(day.format("1997-01-01")), F.expr(day.format("1997-02-01")),
    )
    return found.select(F.col("o_orderkey").alias("id"))


# -- joins and unions ---------------------------------------------------------------------


@query("""SELECT c_custkey AS user_id, c_name AS user_name, l_partkey AS isbn, CAST(l_quantity AS INT) % 11 AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey""")
def join_ratings_users(spark, sf_dir):
    """The few-row tables meet first, so the lines are shuffled once, on the order key, which
    no one reader can make hot."""
    people = t.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name")
    )
    orders = t.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id")
    )
    lines = t.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("isbn"), t.score_of_line()
    )
    by_reader = joins.join_using(orders, people, "user_id")
    return joins.join_using(lines, by_reader, "order_id").select(
        "user_id", "user_name", "isbn", "rating"
    )


@query("""SELECT c.c_custkey AS usernum, c.c_mktsegment AS segment, COUNT(*) AS n
FROM customer c JOIN (SELECT CASE WHEN o_orderkey % 7 = 0 THEN o_custkey || 'x' ELSE CAST(o_custkey AS VARCHAR) END AS k
  FROM orders) o ON c.c_custkey = TRY_CAST(o.k AS BIGINT) GROUP BY 1, 2""")
def join_mixed_keys(spark, sf_dir):
    """Orders carry a text key, every seventh malformed. They are counted per key before the
    join, so a key's share of the orders does not matter."""
    text = F.col("o_custkey").cast("string")
    orders = t.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(text, F.lit("x"))).otherwise(text)
        .alias("usernum")
    )
    people = t.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("usernum"), F.col("c_mktsegment").alias("segment")
    )
    counted = orders.groupBy("usernum").agg(F.count(F.lit(1)).alias("_n"))
    joined = joins.join_text_key(people, counted, "usernum")
    return joined.groupBy("usernum", "segment").agg(F.sum("_n").alias("n"))


@query("""SELECT c_name AS name FROM customer UNION ALL SELECT p_name FROM part
UNION ALL SELECT s_name FROM supplier UNION ALL SELECT c_name FROM customer""")
def names_union(spark, sf_dir):
    customers = t.table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"))
    parts = t.table(spark, sf_dir, "part").select("p_name")
    suppliers = t.table(spark, sf_dir, "supplier").select("s_name")
    return aggregates.union_all([customers, parts, suppliers, customers])


_PAIRS_SQL = """WITH f AS (SELECT p_type, w, row_number() OVER (PARTITION BY p_type ORDER BY w) - 1 AS i
    FROM (SELECT DISTINCT p_type, split_part(p_name, ' ', 1) AS w FROM part)),
  l AS (SELECT p_type, w, row_number() OVER (PARTITION BY p_type ORDER BY w) - 1 AS j,
      COUNT(*) OVER (PARTITION BY p_type) AS n
    FROM (SELECT DISTINCT p_type, split_part(p_name, ' ', 2) AS w FROM part))
SELECT f.p_type AS country, f.w AS firstname, l.w AS lastname FROM f JOIN l ON f.p_type = l.p_type
WHERE (((i * n + j) * 2654435761) % 4294967296) < 1288490188"""


@query(_PAIRS_SQL)
def names_sample(spark, sf_dir):
    """30 % of the pairs of first and last words in the part names of a type."""
    parts = t.table(spark, sf_dir, "part").withColumn("words", F.split("p_name", " "))
    first = parts.select(F.col("p_type").alias("country"), F.get("words", F.lit(0)).alias("firstname"))
    last = parts.select(F.col("p_type").alias("country"), F.get("words", F.lit(1)).alias("lastname"))
    return name_plans.name_pairs(
        first.distinct(), last.distinct(), "country", lambda _country, k: sampling.in_share(k, 0.30)
    )


@query("""WITH f AS (SELECT p_type AS country, COUNT(DISTINCT split_part(p_name, ' ', 1)) * COUNT(DISTINCT split_part(p_name, ' ', 2)) AS pairs
  FROM part GROUP BY 1)
SELECT SUM(pairs)::BIGINT AS pairs, TRUE AS near, TRUE AS without_repeats, TRUE AS all_known, COUNT(*) AS countries FROM f""")
def names_drawn(spark, sf_dir):
    """A third of all pairs as a stated number of names, drawn by gaps, numbered and exported: as many as asked for
    within five deviations, no pair twice, and every one a first and a last name of its country."""
    parts = t.table(spark, sf_dir, "part").withColumn("words", F.split("p_name", " "))
    first = parts.select(F.col("p_type").alias("country"), F.get("words", F.lit(0)).alias("firstname")).distinct()
    last = parts.select(F.col("p_type").alias("country"), F.get("words", F.lit(1)).alias("lastname")).distinct()
    sizes = first.groupBy("country").agg(F.count(F.lit(1)).alias("f")).join(
        last.groupBy("country").agg(F.count(F.lit(1)).alias("l")), "country"
    )
    pairs, countries = sizes.agg(F.sum(F.col("f") * F.col("l")), F.count(F.lit(1))).first()
    path, asked = fresh_path(spark, "names"), pairs // 3
    drawn = keys.unique_ids(name_plans.drawn_pairs(first, last, "country", n=asked, seed=7))
    name_plans.export_names(drawn, path)
    names = spark.read.csv(path, header=True, escape='"')
    known = names.join(first, ["country", "firstname"], "left_semi").join(last, ["country", "lastname"], "left_semi")
    return names.agg(
        F.lit(pairs).alias("pairs"),
        (F.abs(F.count(F.lit(1)) - asked) <= 5 * F.sqrt(F.lit(asked * 2 / 3))).alias("near"),
        ((F.countDistinct("country", "firstname", "lastname") == F.count(F.lit(1))) & (F.countDistinct("id") == F.count(F.lit(1))))
        .alias("without_repeats"),
    ).crossJoin(F.broadcast(known.agg(F.count(F.lit(1)).alias("_known")))).crossJoin(
        F.broadcast(names.agg(F.count(F.lit(1)).alias("_all")))
    ).select("pairs", "near", "without_repeats", (F.col("_known") == F.col("_all")).alias("all_known"), F.lit(countries).alias("countries"))


# -- aggregation --------------------------------------------------------------------------


@query("SELECT l_partkey AS isbn, COUNT(l_quantity) AS n_ratings FROM lineitem GROUP BY 1")
def item_rating_counts(spark, sf_dir):
    return aggregates.group_count(t.item_ratings(spark, sf_dir), "isbn", "rating", "n_ratings")


@query("""WITH t AS (SELECT l_partkey, COUNT(l_quantity) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 10)
SELECT p_partkey AS isbn, n AS n_ratings, p_name AS title, p_brand AS publisher
FROM t JOIN part ON p_partkey = l_partkey""")
def popular_items(spark, sf_dir):
    return recommend.popular_items(t.item_ratings(spark, sf_dir), t.books(spark, sf_dir))


@query("""SELECT 'orders' AS stage, COUNT(*) AS n FROM orders UNION ALL
SELECT 'joined', COUNT(*) FROM orders JOIN customer ON c_custkey = o_custkey AND c_custkey % 5 <> 0""")
def reconcile_counts(spark, sf_dir):
    orders = t.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))
    people = t.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return joins.reconcile(orders, people.filter(F.col("id") % 5 != 0), "id", ("orders", "joined"))


_WORDS_SQL = """WITH ln AS (SELECT unnest(string_split(text, chr(10))) AS s FROM documents),
w AS (SELECT unnest(CASE WHEN s = '' THEN [''] WHEN rtrim(s, ' ') = '' THEN []
  ELSE string_split(rtrim(s, ' '), ' ') END) AS word FROM ln)
SELECT word, COUNT(*) AS n FROM w GROUP BY 1"""


@query(_WORDS_SQL)
def word_count(spark, sf_dir):
    texts = t.table(spark, sf_dir, "documents").select("text")
    return aggregates.word_counts(aggregates.lines_of(texts))


@query("SELECT DISTINCT o_custkey AS user_id FROM orders ORDER BY 1 LIMIT 3")
def distinct_users(spark, sf_dir):
    users = t.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"))
    return aggregates.distinct_first(users, "user_id", 3)


_SUM_SQL = """SELECT c_nationkey AS nation, round(sum(c_acctbal), 2) AS bal FROM customer
GROUP BY 1 HAVING sum(c_acctbal) > 10000"""


@query(_SUM_SQL)
def group_sum_having(spark, sf_dir):
    people = t.table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("bal")
    )
    sums = aggregates.group_sum_above(people, "nation", "bal", 10000, "bal")
    return sums.withColumn("bal", F.round("bal", 2))


@query(_SUM_SQL)
def group_sum_having_sql(spark, sf_dir):
    people = t.table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("bal")
    )
    sums = aggregates.group_sum_above_sql(people, "nation", "bal", 10000, "bal")
    return sums.withColumn("bal", F.round("bal", 2))


@query("SELECT COUNT(*) AS n, TRUE AS numbered FROM lineitem")
def partition_profile(spark, sf_dir):
    """Rows per partition, added up; which partition holds what is Spark's choice."""
    profile = aggregates.partition_profile(t.table(spark, sf_dir, "lineitem").select("l_orderkey"))
    sizes, number = [profile[c] for c in profile.columns if c != "partition"][0], F.col("partition")
    return profile.agg(F.sum(sizes).alias("n"), (F.countDistinct(number) == F.count(number)).alias("numbered"))


@query("""SELECT round(sqrt(avg(power(r - m, 2))), 6) AS rmse
FROM (SELECT CAST(l_quantity AS INT) % 11 AS r, avg(CAST(l_quantity AS INT) % 11) OVER () AS m FROM lineitem)""")
def rmse_baseline(spark, sf_dir):
    lines = t.table(spark, sf_dir, "lineitem").select(t.score_of_line())
    return aggregates.mean_baseline_rmse(lines).select(F.round("rmse", 6).alias("rmse"))


@query("""SELECT round(sqrt(avg(power(CAST(l_quantity AS INT) % 11 - l_discount * 100, 2))), 6) AS rmse
FROM lineitem""")
def rmse_of_column(spark, sf_dir):
    lines = t.table(spark, sf_dir, "lineitem").select(
        t.score_of_line(), (F.col("l_discount") * 100).alias("prediction")
    )
    return aggregates.rmse(lines).select(F.round("rmse", 6).alias("rmse"))


# -- ranking, sampling, identity ----------------------------------------------------------


@query("""SELECT user_id, isbn, rating FROM (SELECT o_custkey AS user_id, l_partkey AS isbn,
  max(CAST(l_quantity AS INT) % 11) AS rating,
  row_number() OVER (PARTITION BY o_custkey ORDER BY max(CAST(l_quantity AS INT) % 11) DESC, l_partkey) AS rn
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) WHERE rn <= 3""")
def topn_per_user(spark, sf_dir):
    rated = t.ratings(spark, sf_dir)
    best = rated.groupBy("user_id", "isbn").agg(F.max("rating").alias("rating"))
    return ranking.top_n_per_group(best, "user_id", "rating", "isbn", 3)


@query("""SELECT o_custkey AS user_id, l_partkey AS isbn, max(CAST(l_quantity AS INT) % 11) AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey = 7 GROUP BY 1, 2
ORDER BY rating DESC, isbn LIMIT 5""")
def topn_of_one_user(spark, sf_dir):
    rated = t.ratings(spark, sf_dir)
    best = rated.groupBy("user_id", "isbn").agg(F.max("rating").alias("rating"))
    return ranking.best_of_one(best, "user_id", 7, "rating", "isbn", 5)


@query("""SELECT CASE WHEN (((l_orderkey * 8 + l_linenumber) % 2147483648 * 2654435761) % 4294967296) < 3435973836
  THEN 'train' ELSE 'test' END AS part, COUNT(*) AS n FROM lineitem GROUP BY 1""")
def holdout_split(spark, sf_dir):
    lines = t.table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    side = F.when(sampling.in_share(key, 0.8), "train").otherwise("test")
    return lines.groupBy(side.alias("part")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS id, c_name AS name FROM customer")
def assign_ids(spark, sf_dir):
    people = t.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"))
    return keys.dense_ids(people, [F.asc("c_custkey")]).select("id", "name")


@query("SELECT COUNT(*) AS n, COUNT(*) AS n_ids, COUNT(DISTINCT c_name) AS n_names FROM customer")
def unique_ids(spark, sf_dir):
    people = t.table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"))
    return keys.unique_ids(people).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_ids"),
        F.countDistinct("name").alias("n_names"),
    )


@query("""SELECT c_name AS name, 1 AS n_ids FROM customer
WHERE ((c_custkey % 2147483648 * 2654435761) % 4294967296) < 1288490188""")
def names_shuffled(spark, sf_dir):
    """A 30 % sample of the readers' names in random order, numbered: which names, and that each has a number."""
    names = t.table(spark, sf_dir, "customer")
    sampled = names.filter(sampling.in_share(F.col("c_custkey"), 0.30)).select(F.col("c_name").alias("name"))
    numbered = materialise(keys.unique_ids(sampling.shuffled(sampled, 7)), "shuffled")
    once = numbered.groupBy("id").agg(F.first("name").alias("name"))
    return once.groupBy("name").agg(F.count(F.lit(1)).cast("int").alias("n_ids"))


@query("""SELECT COUNT(*) AS n, TRUE AS near_share, TRUE AS same_again, TRUE AS uniform FROM lineitem""")
def sample_bernoulli(spark, sf_dir):
    """A seeded sample of 30 % and a random column: the share within five deviations, the same rows from the same
    seed, the random values between 0 and 1 with a mean near a half."""
    lines = t.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    n = lines.count()
    drawn = [
        sampling.bernoulli(lines, 0.30, 7).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("*")).alias("rows"))
        for _ in range(2)
    ]
    first, second = (d.first() for d in drawn)
    return lines.withColumn("r", F.rand(7)).agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(abs(first.n - 0.3 * n) <= 5 * (0.21 * n) ** 0.5).alias("near_share"),
        F.lit(first == second).alias("same_again"),
        ((F.min("r") >= 0) & (F.max("r") < 1) & (F.abs(F.avg("r") - 0.5) < 2 / F.sqrt(F.count(F.lit(1))))).alias("uniform"),
    )


@query("""SELECT 'U' || o_custkey AS user_id, row_number() OVER (ORDER BY COUNT(*) DESC, 'U' || o_custkey) - 1 AS user_num
FROM orders GROUP BY o_custkey""")
def encode_ids(spark, sf_dir):
    users = t.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("user_id")
    )
    return keys.frequency_ids(users, "user_id", recommend.USER).drop("n")


# -- streaming ----------------------------------------------------------------------------


def _published_readers(spark, sf_dir) -> str:
    location = fresh_path(spark, "topic")
    names = reader_plans.enrich_names(t.reader_names(spark, sf_dir), "password", "salt")
    key = F.col("id").cast("bigint")
    # every ninth reader has no age, every tenth a malformed id
    readers = t.readers(spark, sf_dir).select(
        F.when(key % 10 == 0, F.concat("id", F.lit("x"))).otherwise(F.col("id")).alias("id"),
        F.concat("location", F.lit(", a, b")).alias("location"),
        F.when(key % 9 != 0, F.col("age")).alias("age"),
    )
    reader_plans.publish_readers(names, readers, "readers", location=location)
    return location


@query("""SELECT c_name AS firstname, c_mktsegment AS lastname,
  lower(substring(c_name, 1, 4)) || lower(substring(c_mktsegment, 1, 4)) AS username,
  sha256('salt' || 'password') AS password, string_split(l, ',')[1] AS city, string_split(l, ',')[2] AS state,
  string_split(l, ',')[3] AS country, CAST(18 + c_custkey % 60 AS VARCHAR) AS age, c_custkey AS usernum
FROM (SELECT *, c_mktsegment || CASE WHEN c_custkey % 3 > 0 THEN ', ' || c_nationkey ELSE '' END
  || CASE WHEN c_custkey % 3 > 1 THEN ', X' ELSE '' END || ', a, b' AS l FROM customer)
WHERE c_custkey % 9 <> 0 AND c_custkey % 10 <> 0""")
def stream_load_users(spark, sf_dir):
    """Files to messages to documents, the whole way; incomplete readers are rejected."""
    location = _published_readers(spark, sf_dir)
    store = Collection(spark, fresh_path(spark, "readers"))
    load.run_load(
        topics.stream_topic(spark, location), reader_plans.reader_documents(), store,
        fresh_path(spark, "checkpoint"),
    )
    return store.read().drop("_id", load.REST)


@query("""SELECT lpad(lower(to_hex(c_custkey)), 24, '0') AS user_id, c_name AS firstname, c_mktsegment AS lastname,
  CAST(l_partkey AS VARCHAR) AS isbn, CAST(l_quantity AS INT) % 11 AS rating,
  lpad(lower(to_hex(c_custkey)), 24, '0') AS oid
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
WHERE CAST(l_quantity AS INT) % 11 <> 10""")
def stream_load_ratings(spark, sf_dir):
    """Stored readers joined to rating rows, published, and loaded with their object id. A
    rating of ten is written as a word and so rejected."""
    people = Collection(spark, fresh_path(spark, "readers"))
    people.overwrite(t.reader_names(spark, sf_dir).select(
        object_id(F.lpad(F.lower(F.hex("id")), 24, "0")).alias("_id"),
        F.col("id").alias("usernum"), "firstname", "lastname",
    ))
    rated = t.ratings(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("usernum"),
        F.col("isbn").cast("string").alias("ISBN"),
        F.when(F.col("rating") == 10, "ten").otherwise(F.col("rating").cast("string"))
        .alias("rating"),
    )
    location = fresh_path(spark, "topic")
    rating_plans.publish_ratings(people.read(), rated, "ratings", location=location)
    store = Collection(spark, fresh_path(spark, "ratings"))
    load.run_load(
        topics.stream_topic(spark, location), rating_plans.rating_documents(), store,
        fresh_path(spark, "checkpoint"),
    )
    return store.read().select(
        F.col("userId").alias("user_id"), "firstname", "lastname", F.col("ISBN").alias("isbn"),
        "rating", F.col("uid.oid").alias("oid"),
    )


@query("""SELECT CAST(p_partkey AS VARCHAR) AS isbn, p_name AS title, p_brand AS publisher FROM part""")
def stream_load_books(spark, sf_dir):
    """Books published as they are and loaded under the declared schema; the pictures of the
    catalogue are dropped."""
    part = t.books(spark, sf_dir)
    books = part.select(
        F.col("isbn").cast("string").alias("ISBN"), F.col("title").alias("Title"),
        F.lit("").alias("Author"), F.lit("").alias("YearOfPublication"),
        F.col("publisher").alias("Publisher"),
        *[F.lit("").alias(c) for c in ("ImageUrlS", "ImageUrlM", "ImageUrlL")],
    )
    location = fresh_path(spark, "topic")
    book_plans.publish_books(books, "books", location=location)
    store = Collection(spark, fresh_path(spark, "books"))
    load.run_load(
        topics.stream_topic(spark, location), book_plans.book_documents(), store,
        fresh_path(spark, "checkpoint"),
    )
    return book_plans.catalogue(store.read()).select(
        F.col("ISBN").alias("isbn"), F.col("Title").alias("title"),
        F.col("Publisher").alias("publisher"),
    )


@query("""SELECT CAST(p_partkey AS VARCHAR) AS isbn, 2 AS n_series, p_type AS second_series, 0 AS n_similar,
  p_brand AS author, CAST(p_size AS VARCHAR) AS shelf_count FROM part WHERE p_partkey % 8 <> 0""")
def stream_load_rich_books(spark, sf_dir):
    """Rich books from JSON lines, nested values carried as text and typed when loaded. Every
    eighth has shelves that are no JSON and is rejected."""
    parts = t.table(spark, sf_dir, "part")
    plain = {f.name: F.lit("") for f in schemas.RICH_BOOK.fields}
    shelves = F.to_json(F.array(F.struct(
        F.col("p_size").cast("string").alias("count"), F.col("p_name").alias("name")
    )))
    values = plain | {
        "isbn": F.col("p_partkey").cast("string"),
        "series": F.to_json(F.array("p_brand", "p_type")),
        "similar_books": F.lit("[]"),
        "authors": F.to_json(F.array(F.struct(F.col("p_brand").alias("author_id"), F.lit("").alias("role")))),
        "popular_shelves": F.when(F.col("p_partkey") % 8 == 0, F.concat(F.lit("x"), shelves)).otherwise(shelves),
    }
    inbox, location = fresh_path(spark, "json"), fresh_path(spark, "topic")
    parts.select(*[column.alias(name) for name, column in values.items()]).write.json(inbox)
    book_plans.publish_rich_books(files.read_json_text(spark, inbox), "rich", location=location)
    store = Collection(spark, fresh_path(spark, "rich"))
    load.run_load(
        topics.stream_topic(spark, location), book_plans.rich_book_documents(), store,
        fresh_path(spark, "checkpoint"),
    )
    return store.read().select(
        "isbn", F.size("series").alias("n_series"),
        F.get("series", F.lit(1)).alias("second_series"),
        F.size("similar_books").alias("n_similar"),
        F.get("authors", F.lit(0))["author_id"].alias("author"),
        F.get("popular_shelves", F.lit(0))["count"].alias("shelf_count"),
    )


@query("""SELECT CAST(COUNT(*) AS BIGINT) AS messages,
  CAST(COUNT(*) FILTER (o_orderkey % 17 = 0) AS BIGINT) AS rejected FROM orders""")
def batch_metrics(spark, sf_dir):
    """Sizes of the batches of a load, summed: every 17th message is cut off."""
    location = fresh_path(spark, "topic")
    orders = t.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    messages = topics.to_messages(orders, "o_orderkey").withColumn(
        "value",
        F.when(F.col("key").cast("bigint") % 17 == 0, F.substring("value", 1, 9))
        .otherwise(F.col("value")),
    )
    topics.publish(messages, "orders", location=location)
    store, metrics = Collection(spark, fresh_path(spark, "orders")), fresh_path(spark, "metrics")
    schema = T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderpriority", T.StringType())
    ])
    load.run_load(
        topics.stream_topic(spark, location, maxFilesPerTrigger="4"), load.declared(schema), store,
        fresh_path(spark, "checkpoint"), metrics=metrics,
    )
    return load.read_metrics(spark, metrics).agg(
        F.sum("messages").alias("messages"), F.sum("rejected").alias("rejected")
    )


@query("SELECT CAST(o_orderkey AS VARCHAR) AS \"key\", o_orderstatus AS status, COUNT(*) OVER () AS n FROM orders")
def stream_load_live(spark, sf_dir):
    """A load with a batch each second, stopped between two batches after it has drained what was published while
    it ran, and what came after by the next run on its checkpoint."""
    location, checkpoint = fresh_path(spark, "topic"), fresh_path(spark, "checkpoint")
    orders = t.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    store, third = Collection(spark, fresh_path(spark, "orders")), F.col("o_orderkey") % 3

    def send(number):
        topics.publish(topics.to_messages(orders.filter(third == number), "o_orderkey"), "orders", location=location)

    send(0)
    query = load.run_load(
        topics.stream_topic(spark, location), load.declared(orders.schema), store, checkpoint,
        trigger=load.LIVE_TRIGGER, wait=False,
    )
    send(1)
    query.processAllAvailable()
    load.run_for(query, 0.5)
    send(2)
    load.run_load(topics.stream_topic(spark, location), load.declared(orders.schema), store, checkpoint)
    rows = store.read().select(F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderstatus").alias("status"))
    return rows.crossJoin(F.broadcast(rows.agg(F.count(F.lit(1)).alias("n"))))


@query("""SELECT c_custkey AS id, c_name AS name,
  CASE WHEN c_custkey % 2 = 1 THEN c_mktsegment END AS segment FROM customer""")
def stream_load_drifting(spark, sf_dir):
    """Two publishes whose messages have different fields, loaded in batches of their own."""
    location = fresh_path(spark, "topic")
    people = t.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    odd = F.col("id") % 2 == 1
    store = Collection(spark, fresh_path(spark, "people"))
    checkpoint = fresh_path(spark, "checkpoint")
    for part in (people.filter(~odd).drop("segment"), people.filter(odd)):
        topics.publish(topics.to_messages(part, "id"), "people", location=location)
        load.run_load(
            topics.stream_topic(spark, location), load.drifting(store), store, checkpoint
        )
    return store.read().drop("_id")


@query("""SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey END AS nation,
  CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS segment,
  COUNT(*) FILTER (c_custkey % 3 = 0) OVER () AS undeclared FROM customer""")
def stream_load_extra_fields(spark, sf_dir):
    """Every third message has two fields that the loaded schema does not know, one of them nested: they come
    back in ``rest``, and the metrics count them."""
    location = fresh_path(spark, "topic")
    key = F.col("c_custkey")
    more = F.when(key % 3 == 0, F.struct(F.col("c_mktsegment").alias("segment")))
    people = t.table(spark, sf_dir, "customer").select(
        key.alias("id"), F.col("c_name").alias("name"), F.when(key % 3 == 0, F.col("c_nationkey")).alias("nation"),
        more.alias("market"),
    )
    topics.publish(topics.to_messages(people, "id"), "people", location=location)
    store, metrics = Collection(spark, fresh_path(spark, "people")), fresh_path(spark, "metrics")
    load.run_load(
        topics.stream_topic(spark, location), load.declared(people.select("id", "name").schema), store,
        fresh_path(spark, "checkpoint"), metrics=metrics,
    )
    counted = load.read_metrics(spark, metrics).agg(F.sum("undeclared").alias("undeclared"))
    return store.read().select(
        "id", "name", F.variant_get(load.REST, "$.nation", "bigint").alias("nation"),
        F.variant_get(load.REST, "$.market.segment", "string").alias("segment"),
    ).crossJoin(F.broadcast(counted))


@query("""SELECT o_orderkey AS id, CAST(CASE o_orderkey % 4 WHEN 0 THEN o_orderkey WHEN 1 THEN o_orderkey + 0.25
    WHEN 2 THEN (o_orderkey + 0.5) * 1000 END AS DOUBLE) AS amount,
  CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey AS VARCHAR) WHEN 3 THEN o_orderpriority END AS code,
  CASE WHEN o_orderkey % 4 IN (1, 2) THEN o_custkey END AS customer FROM orders""")
def stream_load_widening(spark, sf_dir):
    """Four publishes with other types for a field each: whole numbers, decimals, numbers with an exponent, text;
    the field of a struct and one that is null at first among them. All values come back."""
    location = fresh_path(spark, "topic")
    store, checkpoint = Collection(spark, fresh_path(spark, "orders")), fresh_path(spark, "checkpoint")
    key, orders = F.col("o_orderkey"), t.table(spark, sf_dir, "orders")
    text = key.cast("string")
    kinds = [  # JSON text of the fields, so that each publish has its own types
        F.concat(F.lit('"amount":'), text, F.lit(',"of":{"code":'), text, F.lit('},"customer":null')),
        F.concat(F.lit('"amount":'), text, F.lit('.25,"customer":'), F.col("o_custkey").cast("string")),
        F.concat(F.lit('"amount":'), text, F.lit('.5e3,"customer":'), F.col("o_custkey").cast("string")),
        F.concat(F.lit('"of":{"code":"'), F.col("o_orderpriority"), F.lit('"}')),
    ]
    for kind, fields in enumerate(kinds):
        messages = orders.filter(key % 4 == kind).select(
            text.alias("key"), F.concat(F.lit('{"id":'), text, F.lit(","), fields, F.lit("}")).alias("value")
        )
        topics.publish(messages, "orders", location=location)
        load.run_load(topics.stream_topic(spark, location), load.drifting(store), store, checkpoint)
    return store.read().select(
        "id", F.col("amount").cast("double").alias("amount"), F.col("of.code").alias("code"), "customer"
    )


@query("""SELECT state, COUNT(*) AS n FROM (SELECT CASE WHEN c_custkey % 10 = 0 THEN 'malformed:id'
    WHEN c_custkey % 4 = 0 THEN 'unmatched:id' WHEN c_custkey % 9 = 0 THEN 'null:age' ELSE 'published' END AS state
  FROM customer) GROUP BY 1""")
def publish_accounting(spark, sf_dir):
    """Readers joined to names on ids of text: each is published or rejected with its reason, in one write."""
    key, location = F.col("id").cast("bigint"), fresh_path(spark, "topic")
    names = reader_plans.enrich_names(t.reader_names(spark, sf_dir), "password", "salt")
    readers = t.readers(spark, sf_dir).select(
        F.when(key % 10 == 0, F.concat("id", F.lit("x"))).otherwise(F.col("id")).alias("id"),
        F.concat("location", F.lit(", a, b")).alias("location"),
        F.when(key % 9 != 0, F.col("age")).alias("age"),
    )
    rejected = reader_plans.publish_readers(names.filter(F.col("id") % 4 != 0), readers, "readers", location=location)
    sent = topics.read_topic(spark, location).select(F.lit("published").alias("state"))
    states = sent.unionByName(rejected.select(F.col(contracts.REASON).alias("state")))
    return states.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query(_WORDS_SQL)
def word_count_stream(spark, sf_dir):
    """Documents as lines of text files; the counts of all batches are summed."""
    inbox, output = fresh_path(spark, "lines"), fresh_path(spark, "counts")
    t.table(spark, sf_dir, "documents").select("text").write.text(inbox)
    words.run_word_count(
        topics.stream_lines(spark, inbox, maxFilesPerTrigger="2"), output,
        fresh_path(spark, "checkpoint"),
    )
    return spark.read.parquet(output).groupBy("word").agg(F.sum("n").alias("n"))


@query("SELECT date_trunc('second', ts) AS window_start, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2")
def tumbling_count(spark, sf_dir):
    return words.tumbling_counts(t.table(spark, sf_dir, "events"), "ts", "event_type")


@query("""WITH e AS (SELECT event_type, CAST(date_trunc('second', ts) AS TIMESTAMP) AS window_start, event_id % 10 = 3 AS late FROM events)
SELECT window_start, event_type, COUNT(*) FILTER (NOT late) AS n, COUNT(*) FILTER (late) AS n_late FROM e
GROUP BY 1, 2 HAVING COUNT(*) FILTER (NOT late) > 0
UNION ALL SELECT NULL, 'all late rows', NULL, COUNT(*) FROM e WHERE late""")
def tumbling_count_stream(spark, sf_dir):
    """Windows of a stream that arrives in four files by time and a fifth, of every tenth event, when their windows
    are closed. Final counts are appended; the late rows are counted, and found again per window by a batch count."""
    inbox, output = fresh_path(spark, "events"), fresh_path(spark, "windows")
    events = t.table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), "event_type", (F.col("event_id") % 10 == 3).alias("late")
    )
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    quarter = (last - first) / 4
    closing = events.limit(1).select(F.lit(last + quarter).cast("timestamp").alias("ts"), F.lit("closing").alias("event_type"))
    on_time, late_rows = events.filter(~F.col("late")).drop("late"), events.filter("late").drop("late")
    quarters = [
        on_time.filter((F.col("ts") >= first + i * quarter) & ((F.col("ts") < first + (i + 1) * quarter) if i < 3 else F.lit(True)))
        for i in range(4)
    ]
    dropped, checkpoint = 0, fresh_path(spark, "checkpoint")
    for part in (*quarters, closing, late_rows):
        part.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(part.schema).parquet(inbox)
        dropped += words.run_tumbling_counts(stream, "ts", "event_type", output, checkpoint)
    counts = spark.read.parquet(output).filter("event_type <> 'closing'")
    late_counts = words.tumbling_counts(late_rows, "ts", "event_type").withColumnRenamed("n", "n_late")
    found = counts.join(late_counts, ["window_start", "event_type"], "left").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n",
        F.coalesce("n_late", F.lit(0)).alias("n_late"),
    )
    total = spark.range(1).select(
        F.lit(None).cast("timestamp_ntz").alias("window_start"), F.lit("all late rows").alias("event_type"),
        F.lit(None).cast("bigint").alias("n"), F.lit(dropped).cast("bigint").alias("n_late"),
    )
    return found.unionByName(total)


# -- recommendation -----------------------------------------------------------------------


def _encoded(spark, sf_dir) -> recommend.Encoded:
    rated = materialise(t.ratings(spark, sf_dir), "rated")  # read three times; joined once
    return recommend.encode(rated, "user_id", "isbn")


def _fitted(spark, sf_dir, **settings):
    encoded = _encoded(spark, sf_dir)
    train, test = sampling.hash_split(encoded.ratings, F.col("row_key"), 0.8)
    return encoded, recommend.fit(train, seed=7, **settings), test


_HELD_OUT_SQL = "((row_key % 2147483648 * 2654435761) % 4294967296) >= 3435973836"


@query(f"""WITH r AS (SELECT o_custkey AS u, l_partkey AS i, l_orderkey * 8 + l_linenumber AS row_key
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
s AS (SELECT u, i, {_HELD_OUT_SQL} AS held_out FROM r)
SELECT COUNT(*) AS kept FROM s WHERE held_out AND u IN (SELECT u FROM s WHERE NOT held_out)
  AND i IN (SELECT i FROM s WHERE NOT held_out)""")
def coldstart_rows(spark, sf_dir):
    rated = t.ratings(spark, sf_dir).select(
        F.col("user_id").alias(recommend.USER), F.col("isbn").alias(recommend.ITEM), "row_key"
    )
    rated = materialise(rated, "rated")  # read three times; joined once
    train, test = sampling.hash_split(rated, F.col("row_key"), 0.8)
    return recommend.known_rows(test, train).agg(F.count(F.lit(1)).alias("kept"))


_SCORED_SQL = f"""WITH r AS (SELECT o_custkey AS u, l_partkey AS i, CAST(l_quantity AS INT) % 11 AS rating,
    l_orderkey * 8 + l_linenumber AS row_key FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
s AS (SELECT *, {_HELD_OUT_SQL} AS held_out FROM r),
k AS (SELECT * FROM s WHERE held_out AND u IN (SELECT u FROM s WHERE NOT held_out) AND i IN (SELECT i FROM s WHERE NOT held_out))
"""


def _checked_scores(factors, test):
    """Scored rows, and whether each score is the product of the two stored vectors, summed another way."""
    scored = recommend.score(factors, test)
    sides = [
        table.select(F.col("id").alias(key), F.col("features").alias(name))
        for table, key, name in ((factors.users, recommend.USER, "_a"), (factors.items, recommend.ITEM, "_b"))
    ]
    terms = F.zip_with("_a", "_b", lambda x, y: x.cast("double") * y.cast("double"))
    product = F.aggregate(terms, F.lit(0.0), lambda x, y: x + y)
    exact = F.abs(F.col("prediction") - product) <= 1e-5 * (1 + F.abs(product))
    checked = scored.join(sides[0], recommend.USER).join(sides[1], recommend.ITEM)
    return checked.select("user_id", "isbn", "rating", exact.alias("exact"))


@query(_SCORED_SQL + "SELECT u AS user_id, i AS isbn, rating, TRUE AS exact FROM k")
def als_predictions(spark, sf_dir):
    _, factors, test = _fitted(spark, sf_dir)
    return _checked_scores(factors, test)


def _solved(factors, train, user_id, implicit=False, alpha=1.0):
    """(user_id, n, solved): whether each user's vector solves its normal equations, with all sums made anew in
    plain expressions: (sum of w v v' + reg n I) u = sum of t v, with the whole other side under it if implicit."""
    rank, rating = factors.rank, F.col("rating").cast("double")
    v = [F.get("_v", F.lit(i)).cast("double") for i in range(rank)]
    u = [F.get("features", F.lit(i)).cast("double") for i in range(rank)]
    users = factors.users.withColumnRenamed("id", recommend.USER)
    items = factors.items.select(F.col("id").alias(recommend.ITEM), F.col("features").alias("_v"))
    rows = train.join(items, recommend.ITEM).join(users, recommend.USER)
    product = sum((a * b for a, b in zip(u, v)), F.lit(0.0))
    weight = F.lit(alpha) * F.abs(rating) if implicit else F.lit(1.0)
    target = F.when(rating > 0, 1.0 + weight).otherwise(0.0) if implicit else rating
    counted = F.count_if(rating > 0) if implicit else F.count(F.lit(1))
    sums = rows.groupBy(recommend.USER, user_id, "features").agg(
        counted.alias("n_reg"), F.count(F.lit(1)).alias("n"),
        *[F.sum((weight * product - target) * v[i]).alias(f"_r{i}") for i in range(rank)],
        F.sum(F.abs(target) * F.greatest(*[F.abs(x) for x in v])).alias("_size"),
    )
    shared = [F.lit(0.0)] * rank
    if implicit:  # the sum of v v' over all items, times u
        whole = [[F.sum(v[i] * v[j]).alias(f"_g{i}_{j}") for j in range(rank)] for i in range(rank)]
        sums = sums.crossJoin(F.broadcast(items.agg(*[c for row in whole for c in row])))
        shared = [sum((F.col(f"_g{i}_{j}") * u[j] for j in range(rank)), F.lit(0.0)) for i in range(rank)]
    left = [F.abs(F.col(f"_r{i}") + shared[i] + recommend.REG * F.col("n_reg") * u[i]) for i in range(rank)]
    return sums.select(user_id, "n", (F.greatest(*left) <= 1e-4 * (1 + F.col("_size"))).alias("solved"))


_TRAINED_SQL = f"""SELECT o_custkey AS user_id, COUNT(*) AS n, TRUE AS solved
FROM (SELECT *, l_orderkey * 8 + l_linenumber AS row_key FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
WHERE NOT ({_HELD_OUT_SQL}) GROUP BY 1"""


@query(_TRAINED_SQL)
def als_solves(spark, sf_dir):
    """Every reader's vector solves its normal equations over the training rows."""
    encoded = _encoded(spark, sf_dir)
    train, _ = sampling.hash_split(encoded.ratings, F.col("row_key"), 0.8)
    return _solved(recommend.fit(train, seed=7), train, "user_id")


@query(_TRAINED_SQL)
def als_implicit_solves(spark, sf_dir):
    encoded = _encoded(spark, sf_dir)
    train, _ = sampling.hash_split(encoded.ratings, F.col("row_key"), 0.8)
    return _solved(recommend.fit(train, seed=7, implicit=True), train, "user_id", implicit=True)


@query(f"""WITH r AS (SELECT o_custkey AS u, l_partkey AS i, CAST(l_quantity AS INT) % 11 AS rating,
    l_orderkey * 8 + l_linenumber AS row_key FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
s AS (SELECT *, {_HELD_OUT_SQL} AS held_out FROM r)
SELECT u AS user_id, i AS isbn, rating, TRUE AS scored FROM s WHERE held_out
  AND u IN (SELECT u FROM s WHERE NOT held_out) AND i IN (SELECT i FROM s WHERE NOT held_out)""")
def als_scored_rows(spark, sf_dir):
    """Which held-out rows get a prediction."""
    _, factors, test = _fitted(spark, sf_dir)
    return recommend.score(factors, test).select(
        "user_id", "isbn", "rating", F.col("prediction").isNotNull().alias("scored")
    )


@query("""SELECT o_custkey AS user_id, COUNT(*) AS n, COUNT(DISTINCT l_partkey) AS n_items,
  CAST(SUM(CAST(l_quantity AS INT) % 11) AS BIGINT) AS total
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def decode_ids(spark, sf_dir):
    """Ratings with numeric ids only, led back through the stored mappings."""
    encoded = _encoded(spark, sf_dir)
    numbers = encoded.ratings.select(recommend.USER, recommend.ITEM, "rating")
    pairs = recommend.decode(numbers, encoded).groupBy("user_id", "isbn").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("total")
    )
    return pairs.groupBy("user_id").agg(
        F.sum("n").alias("n"), F.count("isbn").alias("n_items"), F.sum("total").alias("total")
    )


_ERROR_SQL = _SCORED_SQL + "SELECT COUNT(*) AS n, TRUE AS finite, TRUE AS learns FROM k"


def _errors(spark, sf_dir, **settings):
    """Held-out rows with a score, whether their error is a number, and whether the error over the training rows
    lies below that of their mean (ratings of made-up data tell nothing about others). All rows are scored once."""
    encoded = _encoded(spark, sf_dir)
    ratings = encoded.ratings.withColumn("trained", sampling.in_share(F.col("row_key"), 0.8))
    factors = recommend.fit(ratings.filter("trained").select(recommend.USER, recommend.ITEM, "rating"), seed=7, **settings)
    scored = reduce(DataFrame.unionByName, [
        recommend.score(factors, ratings.filter(F.col("trained") == part).select(recommend.USER, recommend.ITEM, "rating"))
        .withColumn("trained", F.lit(part))
        for part in (True, False)
    ])
    missed = F.pow(F.col("prediction").cast("double") - F.col("rating"), 2)
    trained = F.col("trained")
    error = F.sqrt(F.avg(F.when(~trained, missed)))
    seen, mean = F.sqrt(F.avg(F.when(trained, missed))), F.stddev_pop(F.when(trained, F.col("rating").cast("double")))
    return scored.agg(
        F.count_if(~trained).alias("n"), F.coalesce((error > 0) & (error < 1e6), F.lit(False)).alias("finite"),
        (seen < mean).alias("learns"),
    )


@query(_ERROR_SQL)
def als_rmse(spark, sf_dir):
    return _errors(spark, sf_dir)


@query(_ERROR_SQL)
def als_split_rmse(spark, sf_dir):
    """The same under its earlier name, which asks for the solver."""
    return _errors(spark, sf_dir, solver="split")


@query(_SCORED_SQL + "SELECT u AS user_id, i AS isbn, rating, TRUE AS exact FROM k")
def als_implicit(spark, sf_dir):
    _, factors, test = _fitted(spark, sf_dir, implicit=True)
    return _checked_scores(factors, test)


def _best_of_three(spark, sf_dir, by, of, id_column):
    """(id, place, falling, best): the three best of the three most frequent ids; whether scores fall with the place,
    and whether just as many of all scores of the id are higher as there are places before."""
    encoded, factors, _ = _fitted(spark, sf_dir)
    asked = [r[0] for r in aggregates.distinct_first(encoded.ratings, by, 3).collect()]
    listed = materialise(recommend.recommend(factors, asked, 3, by), "recommended")
    this, other = (factors.users, factors.items) if by == recommend.USER else (factors.items, factors.users)
    pairs = this.filter(F.col("id").isin(asked)).select(F.col("id").alias(by), F.col("features").alias("_a"))
    every = other.select(F.col("id").alias(of), F.col("features").alias("_b")).crossJoin(F.broadcast(pairs))  # three rows
    terms = F.zip_with("_a", "_b", lambda x, y: x.cast("double") * y.cast("double"))
    scores = every.select(by, F.aggregate(terms, F.lit(0.0), lambda x, y: x + y).alias("score"))
    order = Window.partitionBy(by).orderBy(F.desc("rating"), of)
    placed = listed.select(
        by, "rating", F.row_number().over(order).alias("place"),
        (F.coalesce(F.lag("rating").over(order), F.col("rating")) >= F.col("rating")).alias("falling"),
    )
    higher = placed.join(scores, by).groupBy(by, "place", "falling").agg(
        F.count_if(F.col("score") > F.col("rating") + 1e-4 * (1 + F.abs("rating"))).alias("_higher")
    )
    names = (encoded.users if by == recommend.USER else encoded.items).select(by, id_column)
    return higher.join(names, by).select(id_column, "place", "falling", (F.col("_higher") < F.col("place")).alias("best"))


def _asked_sql(key: str, name: str) -> str:
    return f"""SELECT k AS {name}, place, TRUE AS falling, TRUE AS best FROM (SELECT {key} AS k
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 3), (SELECT unnest([1, 2, 3]) AS place)"""


@query(_asked_sql("o_custkey", "user_id"))
def recommend_users(spark, sf_dir):
    """The three best items of three readers."""
    return _best_of_three(spark, sf_dir, recommend.USER, recommend.ITEM, "user_id")


@query(_asked_sql("l_partkey", "isbn"))
def recommend_items(spark, sf_dir):
    """The three best readers of three items."""
    return _best_of_three(spark, sf_dir, recommend.ITEM, recommend.USER, "isbn")


@query("""WITH v AS (SELECT vec_id AS id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS f FROM embeddings),
s AS (SELECT u.id AS user_num, i.id AS item_num, list_inner_product(u.f, i.f) AS rating FROM v u JOIN v i
  ON u.id % 4 = 1 AND i.id % 2 = 0)
SELECT user_num, item_num, rating::FLOAT AS rating FROM s
QUALIFY row_number() OVER (PARTITION BY user_num ORDER BY rating DESC, item_num) <= 3""")
def recommend_all(spark, sf_dir):
    """The three best items of every user, with the embeddings in the roles of fitted vectors: every second an
    item, every fourth a user, components as whole numbers so that products are exact in any order."""
    vectors = t.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("float")).alias("features")
    )
    factors = recommend.Factors(vectors.filter("id % 4 = 1"), vectors.filter("id % 2 = 0"), 64)
    return recommend.recommend_all(factors, 3)


@query("""WITH r AS (SELECT o_custkey AS u, o_orderkey % 3 = 0 AS later FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
a AS (SELECT u, row_number() OVER (ORDER BY COUNT(*) DESC, u) - 1 AS num FROM r WHERE NOT later GROUP BY u),
b AS (SELECT u, (SELECT COUNT(*) FROM a) + row_number() OVER (ORDER BY COUNT(*) DESC, u) - 1 AS num FROM r
  WHERE later AND u NOT IN (SELECT u FROM a) GROUP BY u),
m AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT m.u AS user_id, num AS user_num, COUNT(*) AS n, COUNT(*) FILTER (later) AS n_scored FROM m JOIN r USING (u) GROUP BY 1, 2""")
def als_saved(spark, sf_dir):
    """A model fitted on two thirds of the orders, saved, loaded, extended by the readers and parts of the others,
    trained on and asked for all later ratings: known readers keep their numbers, each later rating has a score."""
    rated = materialise(t.ratings(spark, sf_dir).withColumn("later", F.expr("(row_key div 8) % 3 = 0")), "rated")
    encoded = recommend.encode(rated.filter(~F.col("later")), "user_id", "isbn")
    path = fresh_path(spark, "model")
    recommend.save(path, encoded, recommend.fit(encoded.ratings, iterations=2, seed=7))
    known, factors = recommend.load(spark, path)
    more = recommend.encode_more(known, rated.filter("later"), "user_id", "isbn")
    every = known.ratings.unionByName(more.ratings)
    refitted = recommend.fit(every, iterations=1, seed=7, start=recommend.start_from(factors, more))
    scored = recommend.score(refitted, more.ratings).filter(F.col("prediction").isNotNull() & ~F.isnan("prediction"))
    n_scored = scored.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_scored"))
    return more.users.join(n_scored, "user_id", "left").select(
        "user_id", recommend.USER, "n", F.coalesce("n_scored", F.lit(0)).alias("n_scored")
    )
