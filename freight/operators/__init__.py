"""Relational building blocks; every one takes and returns frames."""

from freight.operators.key_index import key_bitmaps, overlaps, read_key_index, repeated_since, update_key_index
from freight.operators.lanes import enrich_with_lanes, split_lane, split_text
from freight.operators.quality import (
    KeyNotUnique,
    conforms,
    duplicate_profile,
    fan_out,
    key_tests,
    malformed_lanes,
    not_null,
    parse_failure_counts,
    parse_failures,
    require_unique,
    unique,
)
from freight.operators.report import (
    dedupe,
    distinct_descending,
    flatten_star,
    key_profile,
    last_period,
    month_before_latest,
    row_counts,
)
from freight.operators.skew import SALT, hot_keys, join_salted, repeat_hot, spread
from freight.operators.staging import (
    parse_by_name_rule,
    parse_datetimes,
    preview,
    stamp_load_date,
)
from freight.operators.star import build_dimensions, build_fact

__all__ = [
    "KeyNotUnique",
    "SALT",
    "build_dimensions",
    "build_fact",
    "conforms",
    "dedupe",
    "distinct_descending",
    "duplicate_profile",
    "enrich_with_lanes",
    "fan_out",
    "flatten_star",
    "hot_keys",
    "join_salted",
    "key_bitmaps",
    "key_profile",
    "key_tests",
    "last_period",
    "malformed_lanes",
    "month_before_latest",
    "not_null",
    "overlaps",
    "parse_by_name_rule",
    "parse_datetimes",
    "parse_failure_counts",
    "parse_failures",
    "preview",
    "read_key_index",
    "repeat_hot",
    "repeated_since",
    "require_unique",
    "row_counts",
    "split_lane",
    "split_text",
    "spread",
    "stamp_load_date",
    "unique",
    "update_key_index",
]
