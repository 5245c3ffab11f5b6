"""Splitting delimited text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from freight.contract import LANE_ARROW, LANE_COMMA, LANE_PARTS

_REGEX_MARKS = set(r".$|()[]{}^?*+\\")


def _verbatim(delimiter: str) -> str:
    # Only the marks are escaped: a lone "," then keeps Java's split fast path, which
    # a \Q..\E quote would lose.
    return "".join("\\" + c if c in _REGEX_MARKS else c for c in delimiter)


def delimited_parts(column: Column, delimiter: str, literal: bool = True) -> Column:
    """Array of the pieces between delimiters; ``literal=False`` takes a regex."""
    if not delimiter:
        raise ValueError("delimiter must not be empty")
    return F.split(column, _verbatim(delimiter) if literal else delimiter)


def part_at(parts: Column, position: int, trim: bool = False) -> Column:
    """Piece at a 0-based position, NULL where the array is too short."""
    piece = F.get(parts, F.lit(position))
    return F.trim(piece) if trim else piece


def lane_parts(
    lane: Column,
    delimiter: str = LANE_ARROW,
    literal: bool = True,
    trim: bool = False,
) -> dict[str, Column]:
    """Pickup and delivery city and state of a lane; what is missing is NULL."""
    ends = delimited_parts(lane, delimiter, literal)
    pieces = [
        part_at(delimited_parts(part_at(ends, end), LANE_COMMA), place, trim)
        for end in (0, 1)
        for place in (0, 1)
    ]
    return dict(zip(LANE_PARTS, pieces))
