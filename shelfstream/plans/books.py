"""Books, plain and rich: published as they are, typed when they are loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfstream import schemas
from shelfstream.functions.nested import typed_json
from shelfstream.plans.readers import publish_rows
from shelfstream.streaming.load import declared

# The columns the recommender leaves out of the catalogue.
IMAGE_COLUMNS = ("Image-URL-L", "Image-URL-M", "Image-URL-S", "ImageUrlL", "ImageUrlM", "ImageUrlS")


def publish_books(books: DataFrame, topic: str, key: str = "ISBN", **target) -> DataFrame:
    return publish_rows(books, key, topic, **target)


def publish_rich_books(books: DataFrame, topic: str, **target) -> DataFrame:
    """Rich books are keyed by ISBN; nested values travel as JSON text."""
    return publish_rows(books, "isbn", topic, **target)


def book_documents(schema=schemas.BOOK):
    return declared(schema, not_null=["ISBN"])


def rich_book_documents():
    """Rich book messages with their four nested columns typed."""
    return declared(schemas.RICH_BOOK, not_null=["isbn"], nested=schemas.RICH_BOOK_NESTED)


def type_nested(books: DataFrame, nested: dict | None = None) -> DataFrame:
    """The nested columns of a table of rich books, from JSON text to arrays."""
    nested = nested or schemas.RICH_BOOK_NESTED
    return books.withColumns({c: typed_json(c, as_type) for c, as_type in nested.items()})


def catalogue(books: DataFrame) -> DataFrame:
    return books.drop(*IMAGE_COLUMNS)
