"""Topics of keyed text messages.

``fmt="kafka"`` hands all options to Spark's connector. The default is a folder of files:

    location/row_status=valid/partition=P/*.parquet      the topic
    location/row_status=rejected/partition=P/*.parquet   rows that broke their contract, with the reason

It has no server and opens no port. A message is known by its partition, file and row, which Spark's file
source tells; several publishers may add to a topic at once. Both formats give ``message_id``, 24 hex digits
made from where the message lies."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfstream import schemas
from shelfstream.functions.nested import message_object_id, row_json
from shelfstream.operators.contracts import REASON, REJECTED, STATUS, VALID, rejected_rows, valid_rows
from shelfstream.sources import paths
from shelfstream.sources.records import from_pairs

FILES = "parquet"
PUBLISHED = "publish_id"


def to_messages(
    df: DataFrame, key: str, columns: list[str] | None = None, keep: Iterable[str] = ()
) -> DataFrame:
    """(key, value): the named column as text, and the row as a JSON object; and the columns to ``keep``."""
    return df.select(
        F.col(f"`{key}`").cast("string").alias("key"),
        row_json(columns or df.columns).alias("value"), *keep,
    )


def _partition_of(messages: DataFrame, partitions: int) -> Column:
    if "partition" in messages.columns:
        return F.col("partition").cast("int")
    # messages without a key are dealt out in turn
    hashed = F.when(F.col("key").isNull(), F.monotonically_increasing_id()).otherwise(
        F.hash("key").cast("bigint")
    )
    return F.pmod(hashed, F.lit(partitions)).cast("int")


def publish(
    messages: DataFrame,
    topic: str,
    location: str | None = None,
    fmt: str = FILES,
    partitions: int = 4,
    **options: str,
) -> DataFrame | None:
    """Append messages to a topic straight from the tasks that made them: no shuffle, so no
    key, however hot, meets in one task. Rows may name their ``partition``.

    Rows with a ``reject_reason`` do not enter the topic; they are returned as (key, value,
    reject_reason). Files take both kinds in a single pass, side by side."""
    judged = REASON in messages.columns
    if fmt != FILES:
        columns = [c for c in ("key", "value", "partition") if c in messages.columns]
        if judged:  # two sinks: keep the rows, on disk where memory is short, instead of making them twice
            messages = messages.persist(StorageLevel.MEMORY_AND_DISK)
        sent = valid_rows(messages) if judged else messages
        sent.select(*columns).write.format(fmt).options(topic=topic, **options).save()
        return rejected_rows(messages).select("key", "value", REASON) if judged else None
    spark, publish_id = messages.sparkSession, uuid.uuid4().hex
    reason = F.col(REASON) if judged else F.lit(None).cast("string")
    rows = messages.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.lit(topic).alias("topic"),
        F.current_timestamp().alias("timestamp"),
        reason.alias(REASON),
        F.lit(publish_id).alias(PUBLISHED),
        F.when(reason.isNull(), VALID).otherwise(REJECTED).alias(STATUS),
        _partition_of(messages, partitions).alias("partition"),
    )
    for status in (VALID, REJECTED):  # a stream may begin to listen before there is a message
        paths.make_folder(spark, f"{location}/{STATUS}={status}")
    rows.write.mode("append").partitionBy(STATUS, "partition").parquet(location)
    if not judged:
        return None
    kept = T.StructType([f for f in schemas.MESSAGE.fields if f.name in ("key", "value")])
    kept = kept.add(REASON, "string").add(PUBLISHED, "string")
    bad = spark.read.schema(kept).parquet(f"{location}/{STATUS}={REJECTED}")
    return bad.filter(F.col(PUBLISHED) == publish_id).select("key", "value", REASON)


def publish_pairs(
    spark: SparkSession, pairs: Iterable[tuple[str, str]], topic: str, **target
) -> None:
    publish(from_pairs(spark, pairs), topic, **target)


def _as_text(rows: DataFrame) -> DataFrame:
    texts = rows.withColumns({c: F.col(c).cast("string") for c in ("key", "value")})
    return texts.withColumn("message_id", message_object_id(F.col("partition"), F.col("offset")))


def _from_files(rows: DataFrame) -> DataFrame:
    place = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    return rows.select("*", message_object_id(F.col("partition"), *place).alias("message_id"))


def read_topic(
    spark: SparkSession, location: str | None = None, fmt: str = FILES, **options: str
) -> DataFrame:
    """A topic from its beginning to its present end."""
    if fmt != FILES:
        return _as_text(spark.read.format(fmt).options(**options).load())
    return _from_files(spark.read.schema(schemas.MESSAGE).parquet(f"{location}/{STATUS}={VALID}"))


def stream_topic(
    spark: SparkSession, location: str | None = None, fmt: str = FILES, **options: str
) -> DataFrame:
    """A topic as an unbounded table, from the earliest message unless options say
    otherwise. How far it was read is kept in the checkpoint of the query."""
    if fmt != FILES:
        merged = {"startingOffsets": "earliest", **options}
        return _as_text(spark.readStream.format(fmt).options(**merged).load())
    stream = spark.readStream.schema(schemas.MESSAGE).options(**options)
    return _from_files(stream.parquet(f"{location}/{STATUS}={VALID}"))


def stream_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Text lines from files that arrive in a folder."""
    return spark.readStream.option("lineSep", "\n").options(**options).text(path)


def stream_socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Text lines from a listening host."""
    return spark.readStream.format("socket").options(host=host, port=str(port)).load()


def peek(spark: SparkSession, location: str, n: int) -> DataFrame:
    """The first ``n`` messages of a topic of files, partition by partition, in a partition the oldest files
    first. Partitions behind the n-th message are not read."""
    base = f"{location}/{STATUS}={VALID}"
    numbers = sorted(int(p.partition("=")[2]) for p in paths.children(spark, base) if p.startswith("partition="))
    order = [F.col(f"_metadata.{c}") for c in ("file_modification_time", "file_name", "row_index")]
    parts, left = [], n
    for number in numbers:
        rows = spark.read.schema(schemas.MESSAGE).parquet(base).filter(F.col("partition") == number)
        parts.append(rows.orderBy(*order).limit(left).select("partition", "key", "value"))
        left -= parts[-1].count() if number != numbers[-1] else 0
        if left <= 0:
            break
    nothing = spark.createDataFrame([], "partition int, key string, value string")
    return reduce(DataFrame.unionByName, parts) if parts else nothing
