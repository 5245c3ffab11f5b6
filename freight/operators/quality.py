"""Checks.  Each returns the offending rows or groups; an empty result is a pass."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freight.contract import DATE_COLUMNS, KEY, LANE, LANE_ARROW, LANE_COMMA, RAW_DATE_FORMAT
from freight.functions.casts import cast_or_null
from freight.functions.datetimes import parse_wall_clock
from freight.functions.text import delimited_parts, part_at


class KeyNotUnique(ValueError):
    """The key repeats, so a join-free shortcut would give other rows than the joins."""


def not_null(df: DataFrame, column: str = KEY) -> DataFrame:
    """Rows in which ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once, with ``n_records``; NULL keys are left out."""
    keys = list(columns) or [KEY]
    present = df
    for name in keys:
        present = present.where(F.col(name).isNotNull())
    return present.groupBy(*keys).agg(F.count("*").alias("n_records")).where("n_records > 1")


def key_tests(df: DataFrame, key: str = KEY) -> DataFrame:
    """Both key tests in one pass: ``test``, ``failures``."""
    copies = df.groupBy(key).agg(F.count("*").alias("n"))
    missing = F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0))
    repeated = F.count_if(F.col(key).isNotNull() & (F.col("n") > 1))
    totals = copies.agg(missing.alias("not_null"), repeated.alias("unique"))
    return totals.unpivot([], ["not_null", "unique"], "test", "failures")


def require_unique(df: DataFrame, key: str = KEY) -> None:
    """Raise ``KeyNotUnique`` if a non-null ``key`` repeats.  One number reaches the driver."""
    repeated = unique(df, key).count()
    if repeated:
        raise KeyNotUnique(f"{repeated} values of {key} occur more than once")


def duplicate_profile(df: DataFrame, key: str = KEY, top: int | None = None) -> DataFrame:
    """Rows per key, most frequent first; all keys, or the ``top`` ones."""
    totals = df.groupBy(key).agg(F.count("*").alias("total")).orderBy(F.desc("total"), key)
    return totals if top is None else totals.limit(top)


def fan_out(df: DataFrame, key: str = KEY, tables: int = 6) -> DataFrame:
    """Repeated keys with ``total`` copies and the ``joined_rows`` they turn into.

    A join chain of ``tables`` slices of the same table returns ``total ** tables`` rows
    for a key; here the size is known from one count, without running the joins.  It is
    a double, since a hot key leaves the range of integers.
    """
    totals = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("total"))
    joined_rows = reduce(operator.mul, [F.col("total").cast("double")] * tables)
    return totals.where("total > 1").withColumn("joined_rows", joined_rows)


def parse_failures(df: DataFrame, column: str, date_format: str = RAW_DATE_FORMAT) -> DataFrame:
    """Rows whose ``column`` holds text, other than blanks, that is no date."""
    filled = F.trim(F.col(column)) != ""
    return df.where(filled & parse_wall_clock(column, date_format).isNull())


def parse_failure_counts(
    df: DataFrame, columns: Sequence[str] = tuple(DATE_COLUMNS), date_format: str = RAW_DATE_FORMAT
) -> DataFrame:
    """Number of such rows for each of ``columns``, in one pass: ``column_name``, ``failures``."""
    failed = [
        F.count_if((F.trim(name) != "") & parse_wall_clock(name, date_format).isNull()).alias(name)
        for name in columns
    ]
    return df.agg(*failed).unpivot([], list(columns), "column_name", "failures")


def malformed_lanes(df: DataFrame, lane: str = LANE) -> DataFrame:
    """Rows whose lane is not two ends of exactly a city and a state each."""
    ends = delimited_parts(F.col(lane), LANE_ARROW)
    sound = F.array_size(ends) == 2
    for position in (0, 1):
        sound &= F.array_size(delimited_parts(part_at(ends, position), LANE_COMMA)) == 2
    return df.where(F.col(lane).isNotNull() & ~sound)


def conforms(df: DataFrame, contract: T.StructType) -> DataFrame:
    """``df`` against ``contract``, one row per column of either.

    ``status`` is ok, missing, extra or mistyped; ``misfits`` counts the rows without a
    usable value: every row for a missing column, and for a mistyped one the rows whose
    value cannot be cast to the declared type.
    """
    declared = {f.name: f.dataType for f in contract}
    present = {f.name: f.dataType for f in df.schema}
    rows, counts = [], []
    for name in [*declared, *(n for n in present if n not in declared)]:
        wanted, found = declared.get(name), present.get(name)
        if found is None:
            status, misfits = "missing", F.count("*")
        elif wanted is None:
            status, misfits = "extra", F.lit(0)
        elif wanted == found:
            status, misfits = "ok", F.lit(0)
        else:
            value = F.col(name)
            status = "mistyped"
            misfits = F.count_if(value.isNotNull() & cast_or_null(value, found, wanted).isNull())
        rows.append((name, wanted, found, status))
        counts.append(misfits.cast("bigint").alias(name))

    def text(kind: T.DataType | None):
        return F.lit(kind.simpleString() if kind else None).cast("string")

    report = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                text(wanted).alias("declared_type"),
                text(found).alias("found_type"),
                F.lit(status).alias("status"),
                F.col(name).alias("misfits"),
            )
            for name, wanted, found, status in rows
        ]
    )
    return df.agg(*counts).select(F.inline(report))
