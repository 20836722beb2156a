"""Column expressions on JSON text, nested values and object ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Fixed value: the text form of an object id.
OBJECT_ID = "^[0-9a-f]{24}$"
CORRUPT = "_corrupt_record"


def typed_json(c: Column | str, schema: T.DataType) -> Column:
    """JSON text to ``schema``. Text that does not fit gives NULL."""
    return F.from_json(c, schema)


def lost_json(raw: Column, parsed: Column) -> Column:
    """True where there was text and parsing it gave nothing."""
    return raw.isNotNull() & parsed.isNull()


def typed_message(value: Column | str, schema: T.StructType) -> Column:
    """A message's JSON object, with the raw text in ``_corrupt_record`` when it is bad."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return F.from_json(value, with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})


def object_id(c: Column | str) -> Column:
    return F.struct((F.col(c) if isinstance(c, str) else c).alias("oid"))


def object_id_text(c: str) -> Column:
    return F.col(f"{c}.oid")


def bad_object_id(c: Column) -> Column:
    return ~F.coalesce(c.rlike(OBJECT_ID), F.lit(False))


def undeclared_fields(value: Column, names: list[str]) -> tuple[Column, Column]:
    """(whether a JSON object has fields of other names, an object of these as VARIANT). The second is NULL
    where the first is not true, and where the text has a name twice. Field names count letter by letter."""
    known = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    has = F.coalesce(F.size(F.array_except(F.json_object_keys(value), known)) > 0, F.lit(False))
    fields = F.call_function(
        "try_variant_get", F.try_parse_json(value), F.lit("$"), F.lit("map<string,variant>")
    )
    others = F.map_filter(fields, lambda k, _: ~F.array_contains(known, k))
    return has, F.when(has, F.to_variant_object(others))


def message_object_id(partition: Column, *place: Column) -> Column:
    """The 24 hex digits of a document id made from where its message lies: the partition and an offset,
    or a file and a row. The same again after a replay. They begin with 0, ids of an overwrite with f."""
    parts = [partition, *place]
    return F.concat(F.lit("0"), F.substring(F.md5(F.concat_ws("/", *[p.cast("string") for p in parts])), 1, 23))


def row_json(columns: list[str]) -> Column:
    """All columns as one JSON object; NULL fields are left out."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]))
