"""Tables from JSON text whose schema is not known in advance."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

# How the type names of inferred JSON map to column types: whole numbers are bigint, other
# numbers double; a field that is always null, or of several types, is text.
_TYPE_NAMES = {"OBJECT": "STRUCT", "OBJECT<>": "STRING", "VOID": "STRING", "VARIANT": "STRING"}
# The exact types, for loads that widen a field's type later: decimals as they are, always null as no type yet.
_EXACT_NAMES = {"OBJECT": "STRUCT", "OBJECT<>": "STRING", "VARIANT": "STRING"}
_TOKEN = re.compile(r"OBJECT<>|`(?:[^`]|``)*`|DECIMAL\(\d+,\s*\d+\)|[A-Za-z_]\w*(?=\s*[<>,)]|\s*$)")


def _column_type(described: str, exact: bool = False) -> T.DataType:
    def rename(token: re.Match) -> str:
        text = token.group(0)
        if text.startswith("DECIMAL"):
            return text if exact else "DOUBLE"
        return (_EXACT_NAMES if exact else _TYPE_NAMES).get(text, text)

    return T.DataType.fromDDL(_TOKEN.sub(rename, described))


def _fields_of(parsed: DataFrame, column: Column, exact: bool = False) -> T.StructType:
    described = parsed.agg(F.schema_of_variant_agg(column)).first()[0]
    schema = _column_type(described, exact)
    return schema if isinstance(schema, T.StructType) else T.StructType([])


def infer_fields(texts: DataFrame, column: str = "value", exact: bool = False) -> T.StructType:
    """The merged schema of a column of JSON objects, fields in alphabetical order. One
    aggregation with a partial step; only the schema reaches the driver. ``exact`` keeps decimals
    apart from doubles, and fields that are always null without a type."""
    return _fields_of(texts, F.try_parse_json(column), exact)


def read_json_column(
    texts: DataFrame, column: str = "value", schema: T.StructType | None = None
) -> DataFrame:
    """JSON objects as columns, under ``schema`` or the inferred one."""
    fields = schema if schema is not None else infer_fields(texts, column)
    return texts.select(F.from_json(column, fields).alias("_r")).select("_r.*")
