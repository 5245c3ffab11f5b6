"""From a raw drop to the staged table."""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from freight.contract import DATE_COLUMNS, LOAD_DATE, RAW_DATE_FORMAT
from freight.functions.datetimes import load_date, parse_wall_clock

_DATE_WORDS = ("date", "time")


def parse_datetimes(
    df: DataFrame,
    columns: Iterable[str] = tuple(DATE_COLUMNS),
    date_format: str = RAW_DATE_FORMAT,
) -> DataFrame:
    """Replace the named text columns by timestamps, all in one projection."""
    return df.withColumns({name: parse_wall_clock(name, date_format) for name in columns})


def parse_by_name_rule(
    df: DataFrame,
    date_format: str = RAW_DATE_FORMAT,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """Parse every string column whose name contains "date" or "time".

    The rule also catches names such as ``carrier_on_time_overall`` when they arrive as
    text, and would turn their values into NULL: list those in ``exclude``, or use
    ``parse_datetimes``.
    """
    skipped = set(exclude)
    columns = [
        field.name
        for field in df.schema
        if isinstance(field.dataType, T.StringType)
        and field.name not in skipped
        and any(word in field.name.lower() for word in _DATE_WORDS)
    ]
    return parse_datetimes(df, columns, date_format) if columns else df


def stamp_load_date(
    df: DataFrame, value: str | datetime.date | None = None, column: str = LOAD_DATE
) -> DataFrame:
    """Add the load date, today's unless ``value`` is given.

    Pass a value in scheduled jobs: a run that crosses midnight then keeps one date.
    """
    return df.withColumn(column, load_date(value))


def preview(df: DataFrame, view: str, rows: int = 10, order_by: str | None = None) -> DataFrame:
    """Register ``df`` as the temporary view ``view`` and return its first rows by SQL."""
    df.createOrReplaceTempView(view)
    order = f" ORDER BY `{order_by}`" if order_by else ""
    return df.sparkSession.sql(f"SELECT * FROM `{view}`{order} LIMIT {int(rows)}")
