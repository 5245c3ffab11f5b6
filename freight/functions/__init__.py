"""Column expressions: date text and delimited text.  All run inside the JVM."""

from freight.functions.casts import cast_or_null
from freight.functions.datetimes import load_date, month_before, parse_wall_clock
from freight.functions.lattice import common_type
from freight.functions.text import delimited_parts, lane_parts, part_at

__all__ = [
    "cast_or_null",
    "common_type",
    "delimited_parts",
    "lane_parts",
    "load_date",
    "month_before",
    "parse_wall_clock",
    "part_at",
]
