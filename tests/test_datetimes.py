import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freight.contract import RAW
from freight.functions import load_date, month_before, parse_wall_clock
from freight.operators import parse_by_name_rule, parse_datetimes, stamp_load_date

PARSED = {
    "1/2/2024 9:05": dt.datetime(2024, 1, 2, 9, 5),
    " 12/31/2024 23:59 ": dt.datetime(2024, 12, 31, 23, 59),
    "01/02/2024 09:05": dt.datetime(2024, 1, 2, 9, 5),
    "3/10/2024 2:30": dt.datetime(2024, 3, 10, 2, 30),
    "2/29/2024 0:00": dt.datetime(2024, 2, 29),
    "2/30/2024 0:00": None,
    "2/29/2023 0:00": None,
    "13/45/2024 25:61": None,
    "2/29/2024 24:00": None,
    "1/2/2024 9:60": None,
    "1/2/2024": None,
    "1/2/24 9:05": None,
    "1/2/2024 9:05:33": None,
    "2024-01-02 09:05": None,
    "2024-01-02 09:05:00 America/New_York": None,
    "": None,
    "   ": None,
    "soon": None,
    None: None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_parse_is_strict_and_ignores_the_session(spark, zone, ansi):
    before = {key: spark.conf.get(key) for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")}
    spark.conf.set("spark.sql.session.timeZone", zone)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(text,) for text in PARSED], "t string")
        got = {row.t: row.d for row in df.select("t", parse_wall_clock("t").alias("d")).collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == PARSED


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_other_format(spark, zone):
    texts = {
        "2024.01.02 03:04:05": dt.datetime(2024, 1, 2, 3, 4, 5),
        " 2024.03.10 02:30:00": dt.datetime(2024, 3, 10, 2, 30),  # skipped by New York
        "2024.11.03 01:30:00": dt.datetime(2024, 11, 3, 1, 30),  # twice in New York
        "1901.02.03 04:05:06": dt.datetime(1901, 2, 3, 4, 5, 6),
        "2024.13.02 03:04:05": None,
        "": None,
    }
    df = spark.createDataFrame([(text,) for text in texts], "t string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = {r.t: r.d for r in df.select("t", parse_wall_clock("t", "yyyy.MM.dd HH:mm:ss").alias("d")).collect()}
        micros = df.limit(1).select(
            parse_wall_clock(F.lit("05/06/2024 07:08:09.123456"), "dd/MM/yyyy HH:mm:ss.SSSSSS")
        ).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == texts
    assert micros == dt.datetime(2024, 6, 5, 7, 8, 9, 123456)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2199, 12, 31)), min_size=1, max_size=200))
def test_parse_inverts_the_written_form(spark, moments):
    minutes = [m.replace(second=0, microsecond=0) for m in moments]
    texts = [(i, f"{m.month}/{m.day}/{m.year} {m.hour}:{m.minute:02d}") for i, m in enumerate(minutes)]
    df = spark.createDataFrame(texts, "i int, t string").select("i", parse_wall_clock("t").alias("d"))
    assert [row.d for row in df.orderBy("i").collect()] == minutes


def test_parse_datetimes_is_one_projection(spark):
    raw = spark.createDataFrame([], RAW)
    plan = parse_datetimes(raw)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 1
    kinds = dict(parse_datetimes(raw).dtypes)
    assert [n for n, k in kinds.items() if k == "timestamp_ntz"] == [
        "quote_date", "book_date", "source_date", "pickup_date", "delivery_date",
        "pickup_appointment_time", "delivery_appointment_time",
    ]


def test_name_rule_takes_strings_only_and_honours_exclude(spark):
    df = spark.createDataFrame(
        [("1/2/2024 9:05", "Yes", True, "x")], "Pickup_DATE string, on_time string, real_time boolean, a string"
    )
    assert [k for _, k in parse_by_name_rule(df).dtypes] == ["timestamp_ntz", "timestamp_ntz", "boolean", "string"]
    kept = parse_by_name_rule(df, exclude=["on_time"])
    assert tuple(kept.first()) == (dt.datetime(2024, 1, 2, 9, 5), "Yes", True, "x")


def test_load_date_stamp(spark):
    one = spark.range(1)
    assert one.select(load_date("2024-05-01")).first()[0] == "2024-05-01"
    assert one.select(load_date(dt.date(2024, 5, 1))).first()[0] == "2024-05-01"
    today = one.select(load_date().alias("a"), F.current_date().cast("string").alias("b")).first()
    assert today.a == today.b
    assert stamp_load_date(one, "2024-05-01").columns == ["id", "loading_date"]


@pytest.mark.parametrize(
    "moment, expected",
    [
        (dt.datetime(2024, 3, 31, 10, 30), dt.datetime(2024, 2, 29)),
        (dt.datetime(2023, 3, 30), dt.datetime(2023, 2, 28)),
        (dt.datetime(2024, 1, 15, 1, 1), dt.datetime(2023, 12, 15)),
    ],
)
def test_month_before_clamps_and_drops_the_time(spark, moment, expected):
    df = spark.createDataFrame([(moment,)], "t timestamp_ntz")
    assert df.select(month_before(F.col("t"))).first()[0] == expected
