"""The narrowest type that holds the values of several types without changing any."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import types as T

# Narrow to wide, with the digits each holds.
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
# With fractions among them, double holds all of these exactly; a float holds the first three.
_IN_DOUBLE = [T.ByteType, T.ShortType, T.FloatType, T.IntegerType, T.DoubleType]
_DIGITS = 38


def common_type(kinds: Iterable[T.DataType]) -> T.DataType:
    """What all of ``kinds`` can be cast to, whatever their order; text where there is nothing else.

    Whole numbers take the widest type; with fractions they become float or double where those are exact.
    Decimals keep all digits before and behind the point, of whole numbers too.  A date with timestamps is
    midnight (of UTC, where they name an instant).  Arrays, maps and structs are merged part by part: a struct has
    the fields of all, of names that differ in case only the first spelling.
    """
    return reduce(_join, kinds, T.NullType())


def _join(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    pair = {type(a), type(b)}
    if pair <= set(_WHOLE):
        return a if _WHOLE[type(a)] >= _WHOLE[type(b)] else b
    if pair <= {T.DecimalType, *_WHOLE}:
        return _decimal(a, b)
    if pair <= set(_IN_DOUBLE):
        return T.FloatType() if pair <= set(_IN_DOUBLE[:3]) else T.DoubleType()
    if T.DateType in pair and pair & {T.TimestampType, T.TimestampNTZType}:
        return a if isinstance(b, T.DateType) else b
    if pair == {T.ArrayType}:
        return T.ArrayType(_join(a.elementType, b.elementType))
    if pair == {T.MapType}:
        return T.MapType(_join(a.keyType, b.keyType), _join(a.valueType, b.valueType))
    if pair == {T.StructType}:
        return _struct(a, b)
    return T.StringType()


def _decimal(a: T.DataType, b: T.DataType) -> T.DataType:
    def digits(kind: T.DataType) -> tuple[int, int]:
        return (kind.precision - kind.scale, kind.scale) if isinstance(kind, T.DecimalType) else (_WHOLE[type(kind)], 0)

    before, behind = map(max, zip(digits(a), digits(b), strict=True))
    return T.DecimalType(before + behind, behind) if before + behind <= _DIGITS else T.StringType()


def _struct(a: T.StructType, b: T.StructType) -> T.StructType:
    fields = {field.name.lower(): field for field in a}
    for field in b:
        known = fields.get(field.name.lower())
        merged = field if known is None else T.StructField(known.name, _join(known.dataType, field.dataType))
        fields[field.name.lower()] = merged
    return T.StructType([T.StructField(field.name, field.dataType) for field in fields.values()])
