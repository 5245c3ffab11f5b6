"""Staged table to star schema tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freight.contract import FACT, FACT_SOURCES, KEY
from freight.operators.quality import require_unique
from freight.operators.skew import SALT, hot_keys, repeat_hot, spread
from freight.operators.star import build_dimensions, build_fact, join_slices
from freight.sinks.parquet import save_table

# A report filters one month: with rows in date order inside each file, the scan of
# this table skips the row groups of all other months.
_SORT_WITHIN = {"dim_delivery": ["delivery_date"]}


def materialise_star(
    loads: DataFrame,
    database: str = "analytics",
    folder: str | None = None,
    mode: str = "single",
    buckets: int | None = None,
) -> dict[str, DataFrame]:
    """Write the five dimensions, then the fact; return the tables by name.

    In ``single`` mode the key is checked before anything is written, and every table is
    a projection of ``loads``: six pruned scans, no shuffle.  In ``join`` mode the fact
    is joined from the written dimensions; ``quality.fan_out`` tells beforehand how many
    rows that makes.  The counted fact has another grain and is not part of a star.

    ``buckets`` places all tables by key, which costs one shuffle per table here and
    saves all of them in each later join of the star: worth it when reports are run
    repeatedly.  Without ``folder`` the tables go to the warehouse.
    """
    if mode not in ("single", "join"):
        raise ValueError("mode must be 'single' or 'join'")
    if mode == "single":
        require_unique(loads, KEY)

    def save(name: str, df: DataFrame) -> DataFrame:
        path = f"{folder.rstrip('/')}/{name}" if folder else None
        return save_table(
            df, f"{database}.{name}", path, buckets, sort_within=_SORT_WITHIN.get(name)
        )

    star = {name: save(name, df) for name, df in build_dimensions(loads).items()}
    if mode == "single":
        fact = build_fact(loads, mode="single", verify=False)
    else:
        fact = build_fact(loads, star, mode=mode)
    star[FACT] = save(FACT, fact)
    return star


def materialise_salted_fact(
    loads: DataFrame,
    dimensions: Mapping[str, DataFrame],
    database: str,
    folder: str,
    buckets: int,
    hot_parts: int | None = None,
) -> DataFrame:
    """Write what the fact is joined from, bucketed by key and salt, then the fact itself; return the fact with its salt.

    ``fact_keys`` holds the keys of ``loads``, ``<dimension>_salted`` the columns that the fact takes, rows of hot keys once for
    each salt.  Every table costs one shuffle here, in which a key with a large part of all rows is spread over many
    buckets; joins of these tables need none.  Rows without a key match nothing, and only the written fact holds them.
    ``hot_parts`` is as for ``hot_keys``, by default the number of buckets.
    """
    hot = hot_keys(loads, KEY, hot_parts or buckets)
    by = [KEY, SALT]

    def save(name: str, df: DataFrame) -> DataFrame:
        return save_table(df, f"{database}.{name}", f"{folder.rstrip('/')}/{name}", buckets, key=by)

    keys = save("fact_keys", spread(loads.select(KEY).where(F.col(KEY).isNotNull()), hot))
    slices = {
        name: save(f"{name}_salted", repeat_hot(dimensions[name].select(KEY, *columns).where(F.col(KEY).isNotNull()), hot))
        for name, columns in FACT_SOURCES.items()
    }
    fact = join_slices(keys, slices)
    unkeyed = loads.select(KEY).where(F.col(KEY).isNull()).select(
        *[F.lit(None).cast(field.dataType).alias(field.name) for field in fact.schema[:-1]], F.lit(0).alias(SALT)
    )
    return save(f"{FACT}_salted", fact.unionAll(unkeyed))
