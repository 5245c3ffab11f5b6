"""Splitting lanes into cities and states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freight.contract import KEY, LANE, LANE_ARROW, LANE_PARTS
from freight.functions.text import delimited_parts, lane_parts, part_at
from freight.operators.quality import require_unique


def split_text(
    df: DataFrame,
    column: str,
    delimiter: str,
    names: Sequence[str],
    literal: bool = True,
    trim: bool = False,
) -> DataFrame:
    """Add one column per piece of ``column``; missing pieces are NULL, extra ones unused."""
    parts = delimited_parts(F.col(column), delimiter, literal)
    return df.withColumns({name: part_at(parts, i, trim) for i, name in enumerate(names)})


def split_lane(
    df: DataFrame,
    columns: Sequence[str] = (KEY, LANE),
    lane: str = LANE,
    delimiter: str = LANE_ARROW,
    literal: bool = True,
    trim: bool = False,
) -> DataFrame:
    """``columns`` of ``df`` followed by every step of the split.

    ``split_column`` is the array of lane ends, ``origin`` and ``destination`` are its
    items, then come the four cities and states.
    """
    ends = delimited_parts(F.col(lane), delimiter, literal)
    return df.select(
        *columns,
        ends.alias("split_column"),
        part_at(ends, 0, trim).alias("origin"),
        part_at(ends, 1, trim).alias("destination"),
        *[piece.alias(name) for name, piece in lane_parts(F.col(lane), delimiter, literal, trim).items()],
    )


def enrich_with_lanes(
    df: DataFrame,
    key: str = KEY,
    lane: str = LANE,
    delimiter: str = LANE_ARROW,
    mode: str = "single",
    verify: bool = True,
) -> DataFrame:
    """``df`` with its own lane pieces as four more columns.

    ``join`` is the inner self-join on ``key``: it drops rows without a key, and a key
    with k copies comes back k*k times.  ``single`` gives the same rows without a join
    for a key that does not repeat; it checks that first and raises ``KeyNotUnique``
    (``verify=False`` where the caller has checked).
    """
    if mode == "join":
        pieces = split_lane(df, (key, lane), lane, delimiter).select(key, *LANE_PARTS)
        return df.alias("origin").join(pieces, on=key, how="inner").select(
            *[F.col(f"origin.{name}") for name in df.columns], *LANE_PARTS
        )
    if mode != "single":
        raise ValueError("mode must be 'single' or 'join'")
    if verify:
        require_unique(df, key)
    return df.where(F.col(key).isNotNull()).withColumns(lane_parts(F.col(lane), delimiter))
