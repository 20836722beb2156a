"""Which type holds the values of two others, and casts to it that lose no value.

From narrow to wide: no value at all, bigint, decimal, double, string. Structs are widened field by
field, arrays by their elements. What has no common type is text: the JSON text of the value."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

_WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
MOST_DIGITS = 38


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point of an exact number type."""
    if kind in _WHOLE:
        return _WHOLE[kind], 0
    return (kind.precision - kind.scale, kind.scale) if isinstance(kind, T.DecimalType) else None


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return wider_struct(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, wider(a.valueType, b.valueType))
    exact = [_digits(x) for x in (a, b)]
    if None not in exact:
        whole, scale = (max(x) for x in zip(*exact))
        if not scale:
            return T.LongType() if whole <= 19 else T.DecimalType(whole, 0)
        return T.DecimalType(whole + scale, scale) if whole + scale <= MOST_DIGITS else T.DoubleType()
    numbers = [x is not None or isinstance(y, (T.DoubleType, T.FloatType)) for x, y in zip(exact, (a, b))]
    return T.DoubleType() if all(numbers) else T.StringType()


def wider_struct(a: T.StructType, b: T.StructType) -> T.StructType:
    """The fields of ``a``, widened, and then those only ``b`` has."""
    others = {f.name: f.dataType for f in b.fields}
    fields = [(f.name, wider(f.dataType, others.get(f.name, T.NullType()))) for f in a.fields]
    fields += [(f.name, f.dataType) for f in b.fields if f.name not in a.names]
    return T.StructType([T.StructField(n, t) for n, t in fields])


def widened(c: Column, old: T.DataType, new: T.DataType) -> Column:
    """Values of type ``old`` as ``new``, which is at least as wide."""
    if isinstance(old, T.NullType):  # there is no such column in files
        return F.lit(None).cast("string" if isinstance(new, T.NullType) else new)
    if old == new:
        return c
    if isinstance(new, T.StringType):
        return F.to_json(c) if isinstance(old, (T.StructType, T.ArrayType, T.MapType)) else c.cast("string")
    if isinstance(old, T.StructType):
        before = {f.name: f.dataType for f in old.fields}
        fields = [
            widened(c.getField(f.name), before[f.name], f.dataType) if f.name in before else F.lit(None).cast(f.dataType)
            for f in new.fields
        ]
        return F.when(c.isNotNull(), F.struct(*[x.alias(f.name) for x, f in zip(fields, new.fields)]))
    if isinstance(old, T.ArrayType):
        return F.transform(c, lambda x: widened(x, old.elementType, new.elementType))
    if isinstance(old, T.MapType):
        return F.transform_values(c, lambda _, x: widened(x, old.valueType, new.valueType))
    return c.cast(new)
