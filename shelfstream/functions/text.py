"""Column expressions on plain text. All stay inside Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_chars(c: ColumnOrName, n: int = 4) -> Column:
    return F.substring(_col(c), 1, n)


def username(first: ColumnOrName, last: ColumnOrName) -> Column:
    """First four letters of both names in lower case; NULL when either is. Not unique."""
    return F.concat(F.lower(first_chars(first)), F.lower(first_chars(last)))


def salted_digest(value: str, salt: str) -> Column:
    """One constant for all rows; Catalyst folds it before the job starts."""
    return F.sha2(F.concat(F.lit(salt), F.lit(value)), 256)


def location_parts(c: ColumnOrName, trim: bool = False) -> dict[str, Column]:
    """``city,state,country``. A missing part is NULL; text after a comma keeps its leading
    space unless ``trim`` is set; a fourth part is ignored."""
    parts = F.split(_col(c), ",")
    columns = {
        name: F.get(parts, F.lit(i)) for i, name in enumerate(("city", "state", "country"))
    }
    return {name: F.trim(part) for name, part in columns.items()} if trim else columns


def to_int(c: ColumnOrName) -> Column:
    """Text to int: a decimal is truncated, anything else that is no number is NULL."""
    whole = F.regexp_extract(_col(c), r"^([+-]?\d+)\.\d*$", 1)
    return F.coalesce(_col(c).try_cast("int"), whole.try_cast("int"))


def words_of(line: ColumnOrName) -> Column:
    """Words of a line under the JVM split rule: empties between spaces are kept, those at
    the end are dropped, the empty line holds one empty word and a blank line none."""
    line = _col(line)
    body = F.rtrim(line)
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(body == "", F.array().cast("array<string>"))
        .otherwise(F.split(body, " "))
    )
