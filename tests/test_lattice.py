"""Types of several deliveries merged, and values cast to them."""

import datetime as dt
from decimal import Decimal
from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from freight.functions import cast_or_null, common_type
from freight.sources import read_with_drift


def kind(text):
    return T.DataType.fromDDL(text)


@pytest.mark.parametrize(
    "kinds, wanted",
    [
        (["byte", "int", "short"], "int"),
        (["short", "float"], "float"),
        (["int", "float"], "double"),
        (["long", "double"], "string"),
        (["decimal(5,2)", "decimal(7,1)"], "decimal(8,2)"),
        (["decimal(5,2)", "int"], "decimal(12,2)"),
        (["decimal(5,2)", "int", "long"], "decimal(21,2)"),
        (["decimal(38,0)", "decimal(10,5)"], "string"),
        (["decimal(5,2)", "double"], "string"),
        (["date", "timestamp_ntz"], "timestamp_ntz"),
        (["date", "timestamp"], "timestamp"),
        (["date", "timestamp", "timestamp_ntz"], "string"),
        (["boolean", "int"], "string"),
        (["void", "int"], "int"),
        (["array<int>", "array<long>"], "array<long>"),
        (["array<int>", "int"], "string"),
        (["map<string,int>", "map<string,decimal(4,2)>"], "map<string,decimal(12,2)>"),
        (["struct<a:int>", "struct<b:string>"], "struct<a:int,b:string>"),
        (["struct<a:struct<x:int>>", "struct<A:struct<y:date>>"], "struct<a:struct<x:int,y:date>>"),
        (["array<struct<a:date>>", "array<struct<a:timestamp_ntz,b:int>>"], "array<struct<a:timestamp_ntz,b:int>>"),
    ],
)
def test_common_type(spark, kinds, wanted):
    def lower(found):
        return found.simpleString().lower()

    for order in permutations(kinds):
        found = common_type(map(kind, order))
        assert sorted(lower(found)) == sorted(lower(kind(wanted))), order  # fields come as first seen
    assert lower(common_type(map(kind, kinds))) == lower(kind(wanted))


leaves = st.sampled_from(
    [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(5, 2), T.DecimalType(20, 10),
     T.DecimalType(38, 0), T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType(), T.TimestampNTZType()]
)
kinds_ = st.recursive(leaves, lambda inner: inner.map(T.ArrayType) | st.lists(inner, min_size=1, max_size=3).map(lambda k: T.StructType([T.StructField(f"f{i}", x) for i, x in enumerate(k)])), max_leaves=4)


@settings(max_examples=200, deadline=None)
@given(st.lists(kinds_, min_size=1, max_size=4), st.randoms(use_true_random=False))
def test_order_and_grouping_play_no_part(kinds, rng):
    whole = common_type(kinds)
    mixed = kinds[:]
    rng.shuffle(mixed)
    cut = rng.randint(0, len(kinds))

    def shape(found):
        if isinstance(found, T.StructType):
            return sorted((f.name, str(shape(f.dataType))) for f in found)
        return [shape(found.elementType)] if isinstance(found, T.ArrayType) else found.simpleString()

    assert shape(common_type(mixed)) == shape(whole)
    assert shape(common_type([common_type(kinds[:cut]), common_type(kinds[cut:])])) == shape(whole)


def test_nested_drift(spark, tmp_path):
    path = str(tmp_path / "drift")

    def deliver(ddl, *rows):
        spark.createDataFrame(rows, ddl).write.mode("append").parquet(path)

    deliver("id long, s struct<a:int,t:array<struct<d:date>>>, m map<string,int>, p decimal(5,2)",
            (1, (1, [(dt.date(2024, 3, 31),), None]), {"x": 1}, Decimal("1.25")), (2, None, None, None))
    deliver("id long, s struct<b:string,A:decimal(6,3),t:array<struct<d:timestamp_ntz,e:int>>>, m map<string,decimal(6,3)>, p decimal(6,3)",
            (3, ("q", Decimal("3.500"), [(dt.datetime(2024, 3, 31, 2, 30), 7)]), {"y": Decimal("2.125")}, Decimal("3.500")))
    found = read_with_drift(spark, path)
    types = {f.name: f.dataType.simpleString().lower() for f in found.schema}
    assert types["p"] == "decimal(6,3)" and types["m"] == "map<string,decimal(13,3)>"
    rows = {r.id: r for r in found.collect()}

    def lowered(row):
        return {name.lower(): value for name, value in row.asDict().items()}

    one, three = lowered(rows[1].s), lowered(rows[3].s)
    assert one["a"] == 1 and one["b"] is None and three["a"] == Decimal("3.500") and three["b"] == "q"
    assert [x and x.asDict() for x in one["t"]] == [{"d": dt.datetime(2024, 3, 31), "e": None}, None]
    assert [x.asDict() for x in three["t"]] == [{"d": dt.datetime(2024, 3, 31, 2, 30), "e": 7}]
    assert rows[1].m == {"x": Decimal("1.000")} and rows[3].m == {"y": Decimal("2.125")}
    assert rows[2].s is None and rows[2].m is None and rows[1].p == Decimal("1.250")


def test_nested_text_and_misfits(spark, tmp_path):
    path = str(tmp_path / "drift")
    spark.createDataFrame([(1, (1, "x"))], "id long, v struct<a:int,b:string>").write.parquet(path)
    spark.createDataFrame([(2, "plain")], "id long, v string").write.mode("append").parquet(path)
    assert {r.id: r.v for r in read_with_drift(spark, path).collect()} == {1: '{"a":1,"b":"x"}', 2: "plain"}
    contract = T.StructType.fromDDL("id long, v struct<a:long>")
    assert {r.id: r.v and r.v.a for r in read_with_drift(spark, path, contract).collect()} == {1: 1, 2: None}


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_dates_among_instants(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame([(dt.date(2024, 3, 10),)], "d date")
        instant = cast_or_null(frame["d"], T.DateType(), T.TimestampType())
        assert frame.select(instant.cast("long").alias("s")).first().s == 1710028800
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
