import datetime as dt

import pytest
from pyspark.sql import functions as F

from freight.contract import FACT, KEY, REPORT_COLUMNS
from freight.operators import (
    build_dimensions,
    build_fact,
    dedupe,
    distinct_descending,
    flatten_star,
    key_profile,
    last_period,
    month_before_latest,
    preview,
    row_counts,
)
from freight.operators.report import TABLES
from freight.plans import last_month_report

from .conftest import rows_of


def star_of(loads, mode="join"):
    return {**build_dimensions(loads), FACT: build_fact(loads, mode=mode)}


def test_flat_star(loads):
    flat = flatten_star(star_of(loads))
    assert flat.columns == REPORT_COLUMNS
    row = flat.where(F.col(KEY) == 5).first()
    assert tuple(row) == (5, "s", dt.datetime(2024, 2, 1, 23, 59), "Reno", "NV", "Boise", "ID", None, None)


def test_flat_star_drops_rows_without_a_key(loads):
    rows = loads.replace({4: None}, subset=[KEY])
    assert flatten_star(star_of(rows)).count() == 4


@pytest.mark.parametrize(
    "mode, kept", [("instant", [2]), ("day", [2, 3]), ("calendar_month", [2, 3, 5])]
)
def test_last_period(loads, mode, kept):
    got = last_period(loads, "delivery_date", mode)
    assert sorted(row[KEY] for row in got.collect()) == kept


def test_last_period_edges(loads):
    assert last_period(loads.limit(0), "delivery_date", "calendar_month").count() == 0
    with pytest.raises(ValueError):
        last_period(loads, mode="year")


def test_month_before_latest(loads):
    row = month_before_latest(loads, "delivery_date").first()
    assert tuple(row) == (
        dt.datetime(2024, 3, 31, 10, 30), dt.date(2024, 2, 29), dt.datetime(2024, 2, 29),
    )


@pytest.mark.parametrize("mode", ["instant", "day", "calendar_month"])
def test_report_modes_agree(loads, mode):
    star = star_of(loads)
    plain = dedupe(last_period(flatten_star(star), "delivery_date", mode))
    assert rows_of(last_month_report(star, mode)) == rows_of(plain)
    assert rows_of(last_month_report(star, mode, keys_checked=True)) == rows_of(plain)


def test_report_over_repeated_and_differing_keys(loads):
    """Copies in some tables, other values in others, a key that one table lacks."""
    star = star_of(loads)
    star["dim_book"] = star["dim_book"].unionAll(star["dim_book"].withColumn("book_price", F.lit(1.5)))
    star["dim_carriers"] = star["dim_carriers"].unionAll(star["dim_carriers"])
    star["dim_pickup"] = star["dim_pickup"].where(F.col(KEY) != 1)  # key 1 holds the latest date
    star[FACT] = star[FACT].unionAll(star[FACT])
    for mode in ("instant", "day", "calendar_month"):
        plain = dedupe(last_period(flatten_star(star), "delivery_date", mode))
        assert rows_of(last_month_report(star, mode)) == rows_of(plain)
    flat = flatten_star(star)
    assert rows_of(flatten_star(star, distinct=True)) == rows_of(flat.dropDuplicates())
    repeated = ["dim_book", "dim_carriers", FACT]
    profile = key_profile(star).first()
    assert profile.delivery_date == flat.agg(F.max("delivery_date")).first()[0]
    assert {name for name in TABLES if profile[name] > 1} == set(repeated)


def test_report_over_a_key_with_very_many_copies(spark, loads):
    star = star_of(loads)
    many = spark.range(3000).select()
    star = {name: df.where(F.col(KEY) == 2).join(many).unionAll(df) for name, df in star.items()}
    assert last_month_report(star, "calendar_month").count() == 3


def test_a_wrong_promise_repeats_no_row(loads):
    star = star_of(loads)
    star["dim_book"] = star["dim_book"].unionAll(star["dim_book"])
    assert rows_of(last_month_report(star, "day", keys_checked=True)) == rows_of(last_month_report(star, "day"))


def test_report_over_empty_tables(loads):
    star = {name: df.limit(0) for name, df in star_of(loads).items()}
    assert last_month_report(star, "calendar_month").count() == 0
    assert last_month_report(star, "calendar_month", keys_checked=True).count() == 0


def test_distinct_descending(loads):
    dates = [row[0] for row in distinct_descending(loads.unionAll(loads), "delivery_date").collect()]
    assert dates == sorted((d for d in dates if d), reverse=True) + [None]
    assert len(dates) == 5


def test_row_counts(loads):
    got = row_counts({"all": loads, "none": loads.limit(0)}).collect()
    assert {tuple(row) for row in got} == {("all", 5), ("none", 0)}


def test_preview(spark, loads):
    got = preview(loads, "some_loads", rows=2, order_by=KEY)
    assert [row[KEY] for row in got.collect()] == [1, 2]
    assert spark.sql("SELECT count(*) FROM some_loads").first()[0] == 5
    assert preview(loads, "some_loads").count() == 5
