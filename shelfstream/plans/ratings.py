"""Ratings: stored readers joined to rating rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfstream import schemas
from shelfstream.functions.nested import bad_object_id, object_id, object_id_text
from shelfstream.functions.text import to_int
from shelfstream.operators.contracts import REASON
from shelfstream.operators.joins import join_accounted
from shelfstream.plans.readers import publish_rows
from shelfstream.streaming.load import declared


def rated_books(stored_readers: DataFrame, ratings: DataFrame) -> DataFrame:
    """(userId, firstname, lastname, ISBN, rating) for every rating, and ``reject_reason`` where its reader's
    number is malformed or not stored. The rating is a whole number, NULL where its text is none."""
    people = stored_readers.select("usernum", "_id", "firstname", "lastname")
    joined = join_accounted(people, ratings, "usernum")
    return joined.select(
        object_id_text("_id").alias("userId"), "firstname", "lastname", "ISBN",
        to_int("rating").alias("rating"), REASON,
    )


def publish_ratings(
    stored_readers: DataFrame, ratings: DataFrame, topic: str, **target
) -> DataFrame:
    return publish_rows(rated_books(stored_readers, ratings), "userId", topic, **target)


def rating_documents():
    """How a batch of rating messages becomes documents: the reader's id is kept as text and,
    as an object id, in ``uid``."""
    return declared(
        schemas.RATING_MESSAGE,
        not_null=["userId", "ISBN"],
        checks=[("object_id:userId", F.col("userId").isNotNull() & bad_object_id(F.col("userId")))],
        derived={"uid": object_id("userId")},
    )
