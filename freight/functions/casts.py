"""Casting a value that may not fit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NESTED = (T.ArrayType, T.MapType, T.StructType)


def cast_or_null(column: Column, found: T.DataType, wanted: T.DataType) -> Column:
    """``column`` as ``wanted``, NULL where it does not fit.

    A number fits if nothing is lost: cast back, it must be the same number.  A date becomes midnight, of UTC
    for an instant.  Arrays, maps and structs are cast part by part; a struct gets NULL for fields it lacks, and
    loses those that are not wanted.  As text they are JSON.  Nothing else becomes an array, a map or a struct.

    Types with no direct cast between them, such as boolean and timestamp, go by way
    of text, so that the query is valid whatever types a file brings.
    """
    if found == wanted:
        return column
    if type(found) is type(wanted) and isinstance(found, _NESTED):
        return _nested(column, found, wanted)
    if isinstance(wanted, _NESTED) or isinstance(found, T.NullType):
        return F.lit(None).cast(wanted)
    if isinstance(found, _NESTED):
        return F.to_json(column).try_cast(wanted)
    if isinstance(found, T.NumericType) and isinstance(wanted, T.NumericType):
        fitted = column.try_cast(wanted)
        return F.when(fitted.try_cast(found).eqNullSafe(column), fitted)
    if isinstance(found, T.DateType) and isinstance(wanted, T.TimestampType):
        return F.timestamp_seconds(F.unix_date(column).cast("long") * 86400)
    return column.cast("string").try_cast(wanted)


def _nested(column: Column, found: T.DataType, wanted: T.DataType) -> Column:
    if isinstance(found, T.ArrayType):
        return F.transform(column, lambda item: cast_or_null(item, found.elementType, wanted.elementType))
    if isinstance(found, T.MapType):
        keyed = F.transform_keys(column, lambda key, _: cast_or_null(key, found.keyType, wanted.keyType))
        return F.transform_values(keyed, lambda _, value: cast_or_null(value, found.valueType, wanted.valueType))
    present = {field.name.lower(): field for field in found}
    fields = []
    for field in wanted:
        own = present.get(field.name.lower())
        value = F.lit(None).cast(field.dataType) if own is None else cast_or_null(column.getField(own.name), own.dataType, field.dataType)
        fields.append(value.alias(field.name))
    return F.when(column.isNotNull(), F.struct(*fields))
