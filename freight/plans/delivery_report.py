"""Star schema to the report of last month's deliveries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freight.contract import KEY
from freight.operators.report import dedupe, flatten_star, key_profile, last_period


def last_month_report(
    star: Mapping[str, DataFrame], mode: str = "instant", keys_checked: bool = False
) -> DataFrame:
    """The flattened star, one month before its latest delivery, each row once.

    In general the tables may repeat keys or hold different ones: the month is that before
    the latest delivery of the keys that all tables share, found by one aggregate over
    the keys inside the same query, and copies are merged within each table.

    ``keys_checked=True`` says that the star was built in ``single`` mode: every table has
    the same keys, none of them twice.  The latest date is then that of ``dim_delivery``
    alone, a scan of one column, and the tables are joined as they are; the few rows that are
    left are still deduplicated, should the promise be wrong.
    """
    deliveries = star["dim_delivery"]
    if keys_checked:
        flat = last_period(flatten_star(star), "delivery_date", mode, deliveries.where(F.col(KEY).isNotNull()))
        return dedupe(flat)
    month = last_period(deliveries, "delivery_date", mode, key_profile(star))
    return flatten_star({**star, "dim_delivery": month}, distinct=True)
