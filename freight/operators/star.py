"""The star schema: five keyed slices of the wide table, and the fact built from them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freight.contract import DIMENSIONS, FACT_COLUMNS, FACT_SOURCES, KEY, LANE, LANE_PARTS, described
from freight.functions.text import lane_parts
from freight.operators.quality import require_unique
from freight.operators.skew import SALT, hot_keys, join_salted, repeat_hot, spread

_COPIES = "decimal(38,0)"


def build_dimensions(loads: DataFrame) -> dict[str, DataFrame]:
    """One frame per dimension, each a projection of ``loads`` with documented columns."""
    pieces = lane_parts(F.col(LANE))
    return {
        name: loads.select(
            *[described(c, pieces[c] if c in LANE_PARTS else None) for c in columns]
        )
        for name, columns in DIMENSIONS.items()
    }


def build_fact(
    loads: DataFrame,
    dimensions: Mapping[str, DataFrame] | None = None,
    mode: str = "single",
    verify: bool = True,
    hot_parts: int | None = None,
) -> DataFrame:
    """The fact table: for each source row, what the five dimensions hold for its key.

    ``join`` left-joins ``loads`` to the dimensions (built from ``loads`` unless given).
    A key with k copies comes back k to the sixth times; ``quality.fan_out`` tells the
    size beforehand.  Rows without a key match nothing; they skip the joins, where they
    would all meet in one task.  With ``hot_parts`` the rows of keys that hold more than one of so many equal
    parts of ``loads`` are spread over several tasks (see ``skew``).

    ``counted`` gives those rows each once, with the number of times the joins return it
    in ``copies``.  Equal parts are merged before the joins, so copies of a load cost no
    more than the load itself, however often it was delivered.

    ``single`` gives the same rows as one projection, no join and no shuffle, for a key
    that does not repeat and dimensions that are slices of ``loads``.  It checks the
    key first and raises ``KeyNotUnique`` (``verify=False`` where the caller has checked).
    """
    if mode == "join":
        return _fact_by_joins(loads, dimensions or build_dimensions(loads), hot_parts)
    if mode == "counted":
        return _fact_counted(loads, dimensions or build_dimensions(loads))
    if mode != "single":
        raise ValueError("mode must be 'single', 'join' or 'counted'")
    if dimensions is not None:
        raise ValueError("given dimensions need mode='join' or 'counted'")
    if verify:
        require_unique(loads, KEY)
    keyed = F.col(KEY).isNotNull()
    return loads.select(
        described(KEY), *[described(c, F.when(keyed, F.col(c))) for c in FACT_COLUMNS if c != KEY]
    )


def _fact_by_joins(loads: DataFrame, dimensions: Mapping[str, DataFrame], hot_parts: int | None) -> DataFrame:
    keys = loads.select(KEY)
    keyed = keys.where(F.col(KEY).isNotNull())
    slices = {name: dimensions[name].select(KEY, *columns) for name, columns in FACT_SOURCES.items()}
    if hot_parts:
        hot = hot_keys(loads, KEY, hot_parts)
        fact = join_slices(spread(keyed, hot), {name: repeat_hot(part, hot) for name, part in slices.items()})
    else:
        fact = keyed
        for part in slices.values():
            fact = fact.join(part, on=KEY, how="left")
    fact = fact.select(*[described(c) for c in FACT_COLUMNS])
    unkeyed = keys.where(F.col(KEY).isNull()).select(
        *[F.lit(None).cast(field.dataType).alias(field.name) for field in fact.schema]
    )
    return fact.unionAll(unkeyed)


def join_slices(keys: DataFrame, slices: Mapping[str, DataFrame]) -> DataFrame:
    """Salted ``keys`` left-joined to the repeated slices of every dimension: the fact's columns and the salt."""
    fact = keys
    for name, columns in FACT_SOURCES.items():
        fact = join_salted(fact, slices[name].select(KEY, SALT, *columns), how="left")
    return fact.select(*[described(c) for c in FACT_COLUMNS], SALT)


def _fact_counted(loads: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    # Counts are decimals without a fraction: a product beyond 38 digits is an error, never a rounded number.
    def merged(rows: DataFrame, count: str) -> DataFrame:
        return rows.groupBy(*rows.columns).agg(F.count("*").cast(_COPIES).alias(count))

    def times(left: Column, right: Column) -> Column:
        return (left * right).cast(_COPIES)

    keys = merged(loads.select(KEY), "n_source")
    fact = keys.where(F.col(KEY).isNotNull())
    counts = ["n_source"]
    for name, columns in FACT_SOURCES.items():
        counts.append(f"n_{name}")
        part = dimensions[name].select(KEY, *columns).where(F.col(KEY).isNotNull())
        fact = fact.join(merged(part, counts[-1]), on=KEY, how="left")
    copies = reduce(times, [F.coalesce(F.col(n), F.lit(1).cast(_COPIES)) for n in counts])
    fact = fact.select(*[described(c) for c in FACT_COLUMNS], copies.alias("copies"))
    unkeyed = keys.where(F.col(KEY).isNull()).select(
        *[F.lit(None).cast(field.dataType).alias(field.name) for field in fact.schema[:-1]], "n_source"
    )
    return fact.unionAll(unkeyed)
