"""The delivery report over the star schema."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freight.contract import DIMENSIONS, FACT, KEY, REPORT_SOURCES
from freight.functions.datetimes import month_before


TABLES = [FACT, *DIMENSIONS]


def flatten_star(star: Mapping[str, DataFrame], distinct: bool = False) -> DataFrame:
    """Fact inner-joined to its five dimensions, reduced to the report columns.

    A key with c, d, ... copies in the six tables comes back c * d * ... times.  With
    ``distinct`` each row comes back once: every table is first reduced to one row a key
    that holds the distinct report columns, merged before its shuffle, so copies never
    multiply and never meet; the joins need no further shuffle.
    """

    def part(name: str) -> DataFrame:
        columns = [column for column, table in REPORT_SOURCES if table == name]
        rows = star[name].select(KEY, *columns).where(F.col(KEY).isNotNull())
        if distinct and columns:
            rows = rows.groupBy(KEY).agg(F.collect_set(F.struct(*columns)).alias(f"of_{name}"))
        elif distinct:
            rows = rows.groupBy(KEY).agg(F.lit(True).alias(f"of_{name}"))
        return rows.alias(name)

    # The report filters deliveries: with that table first, every later join has only
    # the filtered rows on its left.
    first, *others = sorted(TABLES, key=lambda name: name != "dim_delivery")
    flat = part(first)
    for name in others:
        flat = flat.join(part(name), F.col(f"{first}.{KEY}") == F.col(f"{name}.{KEY}"), "inner")
    if not distinct:
        return flat.select(f"{FACT}.{KEY}", *[f"{table}.{column}" for column, table in REPORT_SOURCES])
    tables = list(dict.fromkeys(table for _, table in REPORT_SOURCES))
    flat = flat.select(f"{FACT}.{KEY}", *[f"of_{table}" for table in tables])
    for table in tables:
        flat = flat.select("*", F.explode(f"of_{table}").alias(table))
    return flat.select(KEY, *[f"{table}.{column}" for column, table in REPORT_SOURCES])


def key_profile(star: Mapping[str, DataFrame]) -> DataFrame:
    """One row about the keys of the star: how often the most repeated key of each table
    occurs in it (a column per table), and in ``delivery_date`` the latest delivery of
    the keys that all tables hold, which is the latest of the flattened star.

    One aggregate over the keys of all tables, without any join.  Copies are merged
    map-side, so a key that fills a large part of a table is one row there.
    """
    no_date = F.lit(None).cast("timestamp_ntz").alias("delivery_date")
    keys = [
        star[name].where(F.col(KEY).isNotNull()).select(
            KEY,
            F.col("delivery_date") if name == "dim_delivery" else no_date,
            *[F.lit(int(name == other)).alias(other) for other in TABLES],
        )
        for name in TABLES
    ]
    copies = reduce(DataFrame.unionAll, keys).groupBy(KEY).agg(
        F.max("delivery_date").alias("delivery_date"), *[F.sum(name).alias(name) for name in TABLES]
    )
    everywhere = F.least(*TABLES) > 0
    return copies.agg(
        F.max(F.when(everywhere, F.col("delivery_date"))).alias("delivery_date"),
        *[F.coalesce(F.max(name), F.lit(0)).alias(name) for name in TABLES],
    )


def distinct_descending(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column``, latest first."""
    return df.select(column).distinct().orderBy(F.desc(column))


def month_before_latest(df: DataFrame, column: str) -> DataFrame:
    """One row: the latest ``column``, the day a month earlier, and that day's midnight."""
    latest = F.max(column)
    return df.agg(
        latest.alias("latest"),
        F.add_months(latest, -1).alias("month_earlier"),
        month_before(latest).alias("month_earlier_at"),
    )


def last_period(
    df: DataFrame,
    column: str = "delivery_date",
    mode: str = "instant",
    anchor: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``df`` one month before its latest ``column``.

    ``instant`` keeps rows at exactly midnight of the day one month before the latest
    value, ``day`` the whole of that day, ``calendar_month`` the whole of its month.

    The latest value is a scalar subquery, so nothing passes through the driver, and the
    condition compares the bare column, so it reaches the Parquet scan.  ``anchor``
    names a cheaper frame to take the latest value from, where it is known to hold the
    same one: the joins of a flattened star then run once instead of twice.
    """
    latest = (df if anchor is None else anchor).agg(F.max(column).alias("latest"))
    at = month_before(F.col("latest"))
    value = F.col(column)
    if mode == "instant":
        return df.where(value == latest.select(at).scalar())
    if mode == "day":
        start, length = at, F.make_dt_interval(days=F.lit(1))
    elif mode == "calendar_month":
        start = F.trunc(at, "month").cast("timestamp_ntz")
        length = F.make_ym_interval(months=F.lit(1))
    else:
        raise ValueError("mode must be 'instant', 'day' or 'calendar_month'")
    return df.where(
        (value >= latest.select(start).scalar()) & (value < latest.select(start + length).scalar())
    )


def dedupe(df: DataFrame) -> DataFrame:
    """Each distinct row once.  Copies meet map-side, before the shuffle."""
    return df.dropDuplicates()


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each named table."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)

