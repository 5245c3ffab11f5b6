"""Turning date text into wall-clock timestamps."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from freight.contract import RAW_DATE_FORMAT

_SLASHED = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}):(\d{2})$"
_AS_ISO = "$3-$1-$2 $4:$5:00"


def parse_wall_clock(column: Column | str, date_format: str = RAW_DATE_FORMAT) -> Column:
    """Trimmed text to ``timestamp_ntz``; text that does not fit becomes NULL.

    ``M/d/yyyy H:mm`` is rewritten to ISO order by one regular expression and cast, so
    the session time zone and ANSI mode play no part: an hour skipped by daylight
    saving stays as written.  ``nullif`` drops text the expression left untouched,
    which the cast might otherwise accept in another notation.

    Text in any other format is read as if it named UTC, and the instant is counted
    forward from a wall-clock epoch, which keeps the session zone out as well.
    """
    text = F.trim(F.col(column) if isinstance(column, str) else column)
    if date_format == RAW_DATE_FORMAT:
        iso = F.regexp_replace(text, _SLASHED, _AS_ISO)
        return F.nullif(iso, text).try_cast("timestamp_ntz")
    instant = F.try_to_timestamp(F.concat(text, F.lit(" Z")), F.lit(f"{date_format} X"))
    seconds = (F.unix_micros(instant) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def load_date(value: str | datetime.date | None = None) -> Column:
    """The ``yyyy-MM-dd`` load-date stamp: ``value`` if given, else the current date."""
    if value is None:
        return F.date_format(F.current_date(), "yyyy-MM-dd")
    if isinstance(value, datetime.date):
        value = value.strftime("%Y-%m-%d")
    return F.lit(value)


def month_before(column: Column) -> Column:
    """Midnight of the day one month earlier, clamped to the length of that month."""
    return F.add_months(column, -1).cast("timestamp_ntz")
