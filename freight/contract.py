"""The column contract: one declared schema that every reader and writer uses.

Nothing is inferred from data.  Comments travel as column metadata, so they
reach the catalog when a frame is saved as a table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "load_id"
LOAD_DATE = "loading_date"
LANE = "lane"

# How dates are written in a raw drop, and how a lane is written
# ("city,state -> city,state").
RAW_DATE_FORMAT = "M/d/yyyy H:mm"
LANE_ARROW = " -> "
LANE_COMMA = ","

# Column order, types and membership of the published tables.
_COLUMNS = [
    ("load_id", "bigint", "Identifier of one load; never null, never repeated"),
    ("lane", "string", "Route as 'city,state -> city,state'"),
    ("quote_date", "timestamp_ntz", "When the price was quoted"),
    ("book_date", "timestamp_ntz", "When the shipper booked"),
    ("source_date", "timestamp_ntz", "When a carrier was found"),
    ("pickup_date", "timestamp_ntz", "Planned pickup"),
    ("delivery_date", "timestamp_ntz", "Planned delivery"),
    ("book_price", "double", "Price agreed with the shipper"),
    ("source_price", "double", "Price agreed with the carrier"),
    ("pnl", "double", "Profit or loss as delivered in the drop"),
    ("mileage", "double", "Length of the trip in miles"),
    ("equipment_type", "string", "Trailer or truck type"),
    ("carrier_rating", "int", "Rating given to the carrier"),
    ("sourcing_channel", "string", "Channel that found the carrier"),
    ("vip_carrier", "boolean", "Carrier has VIP standing"),
    ("carrier_dropped_us_count", "int", "Loads this carrier has dropped"),
    ("carrier_name", "string", "Carrier"),
    ("shipper_name", "string", "Shipper"),
    ("carrier_on_time_to_pickup", "boolean", "Arrived on time at pickup"),
    ("carrier_on_time_to_delivery", "boolean", "Arrived on time at delivery"),
    ("carrier_on_time_overall", "boolean", "On time at both ends"),
    ("pickup_appointment_time", "timestamp_ntz", "Appointment at pickup"),
    ("delivery_appointment_time", "timestamp_ntz", "Appointment at delivery"),
    ("has_mobile_app_tracking23", "boolean", "Tracked by mobile app, 2023 version"),
    ("has_mobile_app_tracking24", "boolean", "Tracked by mobile app, 2024 version"),
    ("has_macropoint_tracking", "boolean", "Tracked by Macropoint"),
    ("has_edi_tracking", "boolean", "Tracked by EDI messages"),
    ("contracted_load", "boolean", "Moved under a contract"),
    ("load_booked_autonomously", "boolean", "Booked without a person"),
    ("load_sourced_autonomously", "boolean", "Carrier found without a person"),
    ("load_was_cancelled", "boolean", "Cancelled"),
]

# The lane pieces that the dimensions publish.
LANE_COMMENTS = {
    "pickup_city": "City of the pickup end of the lane",
    "pickup_state": "State of the pickup end of the lane",
    "delivery_city": "City of the delivery end of the lane",
    "delivery_state": "State of the delivery end of the lane",
}
LANE_PARTS = list(LANE_COMMENTS)

# The five vertical slices of the wide table, all keyed by load_id.
DIMENSIONS = {
    "dim_book": [
        "load_id", "quote_date", "book_date", "source_date", "book_price", "source_price",
        "has_mobile_app_tracking23", "has_mobile_app_tracking24", "has_macropoint_tracking",
        "has_edi_tracking", "contracted_load", "load_booked_autonomously",
        "load_sourced_autonomously", "load_was_cancelled",
    ],
    "dim_carriers": [
        "load_id", "carrier_rating", "vip_carrier", "carrier_dropped_us_count", "carrier_name",
        "carrier_on_time_to_pickup", "carrier_on_time_to_delivery", "carrier_on_time_overall",
    ],
    "dim_delivery": [
        "load_id", "delivery_city", "delivery_state", "delivery_date", "delivery_appointment_time",
    ],
    "dim_pickup": [
        "load_id", "pickup_city", "pickup_state", "pickup_date", "pickup_appointment_time",
    ],
    "dim_shippers": [
        "load_id", "pnl", "mileage", "equipment_type", "sourcing_channel", "shipper_name",
    ],
}
FACT = "fact_loads"
# Fact columns after the key, by the dimension that supplies them.
FACT_SOURCES = {
    "dim_book": ["quote_date", "book_date", "source_date", "book_price", "source_price"],
    "dim_carriers": ["carrier_rating", "carrier_dropped_us_count"],
    "dim_delivery": ["delivery_date", "delivery_appointment_time"],
    "dim_pickup": ["pickup_date", "pickup_appointment_time"],
    "dim_shippers": ["pnl", "mileage"],
}
# Report columns in order, each with the table that supplies it.
REPORT_SOURCES = [
    ("shipper_name", "dim_shippers"),
    ("delivery_date", "dim_delivery"),
    ("pickup_city", "dim_pickup"),
    ("pickup_state", "dim_pickup"),
    ("delivery_city", "dim_delivery"),
    ("delivery_state", "dim_delivery"),
    ("book_price", "dim_book"),
    ("carrier_name", "dim_carriers"),
]

FACT_COLUMNS = [KEY] + [c for columns in FACT_SOURCES.values() for c in columns]
REPORT_COLUMNS = [KEY] + [c for c, _ in REPORT_SOURCES]
DATE_COLUMNS = [name for name, kind, _ in _COLUMNS if kind == "timestamp_ntz"]

_LOAD_DATE_COMMENT = "Day the drop was ingested, yyyy-MM-dd; storage partition"
COMMENTS = {name: text for name, _, text in _COLUMNS} | LANE_COMMENTS | {LOAD_DATE: _LOAD_DATE_COMMENT}


_TYPES = {
    "bigint": T.LongType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
}


def _schema(date_type: T.DataType | None = None) -> T.StructType:
    schema = T.StructType()
    for name, kind, text in _COLUMNS:
        declared = _TYPES[kind]
        if date_type is not None and name in DATE_COLUMNS:
            declared = date_type
        schema.add(name, declared, True, {"comment": text})
    return schema


#: A raw drop: dates are still text.
RAW = _schema(date_type=T.StringType())
#: The staged table: dates are wall-clock timestamps, the load date is a string.
STAGED = _schema().add(LOAD_DATE, T.StringType(), True, {"comment": _LOAD_DATE_COMMENT})


def described(name: str, expression: Column | None = None) -> Column:
    """``name`` (or ``expression`` under that name) carrying its contract comment."""
    column = F.col(name) if expression is None else expression
    if name not in COMMENTS:
        return column.alias(name)
    return column.alias(name, metadata={"comment": COMMENTS[name]})
