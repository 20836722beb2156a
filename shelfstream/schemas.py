"""Fixed schemas of the input files and messages."""

from __future__ import annotations

from pyspark.sql import types as T


def all_strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Column names of the input files.
BOOK = all_strings(
    "ISBN", "Title", "Author", "YearOfPublication", "Publisher",
    "ImageUrlS", "ImageUrlM", "ImageUrlL",
)
READER = all_strings("id", "location", "age")
RATING = all_strings("usernum", "ISBN", "rating")
NAME = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("firstname", T.StringType()),
    T.StructField("lastname", T.StringType()),
])
RICH_BOOK = all_strings(
    "isbn", "text_reviews_count", "series", "country_code", "language_code",
    "popular_shelves", "asin", "is_ebook", "average_rating", "kindle_asin",
    "similar_books", "description", "format", "link", "authors", "publisher",
    "num_pages", "publication_day", "isbn13", "publication_month",
    "edition_information", "publication_year", "url", "image_url", "book_id",
    "ratings_count", "work_id",
)

SHELVES = T.ArrayType(all_strings("count", "name"))
AUTHORS = T.ArrayType(all_strings("author_id", "role"))
STRINGS = T.ArrayType(T.StringType())
# how each nested column of a rich book is typed once its message is read
RICH_BOOK_NESTED = {
    "series": STRINGS,
    "similar_books": STRINGS,
    "authors": AUTHORS,
    "popular_shelves": SHELVES,
}

TRIPLET = T.StructType([
    T.StructField("user", T.IntegerType()),
    T.StructField("item", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
])
STUDENT = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("year_graduated", T.StringType()),
    T.StructField("courses_registered", T.ArrayType(all_strings("cid", "sem"))),
    T.StructField("name", T.StringType()),
])

# The columns of a topic's files; the partition is the folder a file lies in.
MESSAGE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("partition", T.IntegerType()),
])

READER_MESSAGE = T.StructType([
    T.StructField(name, T.LongType() if name == "usernum" else T.StringType())
    for name in ("firstname", "lastname", "username", "password",
                 "city", "state", "country", "age", "usernum")
])
RATING_MESSAGE = T.StructType([
    T.StructField(name, T.IntegerType() if name == "rating" else T.StringType())
    for name in ("userId", "firstname", "lastname", "ISBN", "rating")
])
