"""Readers: names and places, published as messages and loaded as documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfstream import schemas
from shelfstream.functions.text import location_parts, salted_digest, username
from shelfstream.operators.contracts import REASON, with_reason
from shelfstream.operators.joins import join_accounted
from shelfstream.sources.topics import publish, to_messages
from shelfstream.streaming.load import declared

CAME = "_reason_it_came_with"


def enrich_names(names: DataFrame, password: str, salt: str) -> DataFrame:
    """Names with a user name and the digest of a starting password."""
    return names.withColumns({
        "username": username("firstname", "lastname"),
        "password": salted_digest(password, salt),
    })


def parse_locations(readers: DataFrame, trim: bool = False) -> DataFrame:
    """(id, location, age) to (id, city, state, country, age)."""
    parts = location_parts("location", trim)
    return readers.select("id", *[c.alias(name) for name, c in parts.items()], "age")


def named_readers(names: DataFrame, readers: DataFrame) -> DataFrame:
    """Every reader with its name, and ``reject_reason`` where the id is malformed or has no name; the id
    leaves as ``usernum``."""
    joined = join_accounted(names, readers, "id")
    return joined.withColumn("usernum", F.col("id")).drop("id")


def publish_rows(
    df: DataFrame, key: str, topic: str, not_null: list[str] | None = None, **target
) -> DataFrame:
    """Publish the rows that have every field of ``not_null`` (all by default) and return
    the others with their reason, one that they came with first.

    Rows are judged and written once, both outcomes side by side."""
    columns = [c for c in df.columns if c != REASON]
    judged = with_reason(df.withColumnRenamed(REASON, CAME), columns if not_null is None else not_null)
    if CAME in judged.columns:
        judged = judged.withColumn(REASON, F.coalesce(CAME, REASON)).drop(CAME)
    messages = to_messages(judged, key, columns, keep=[REASON])
    rejected = publish(messages, topic, **target)
    fields = judged.drop(REASON).schema
    return rejected.select(F.from_json("value", fields).alias("_r"), REASON).select("_r.*", REASON)


def publish_readers(names: DataFrame, readers: DataFrame, topic: str, **target) -> DataFrame:
    return publish_rows(named_readers(names, parse_locations(readers)), "usernum", topic, **target)


def reader_documents():
    """How a batch of reader messages becomes documents."""
    return declared(schemas.READER_MESSAGE, not_null=["usernum"])
