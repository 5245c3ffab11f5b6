import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freight.contract import STAGED
from freight.operators import (
    KeyNotUnique,
    conforms,
    duplicate_profile,
    fan_out,
    key_tests,
    not_null,
    parse_failure_counts,
    parse_failures,
    require_unique,
    unique,
)
from freight.session import settings_for


@pytest.fixture
def keys(spark):
    return spark.createDataFrame([(k,) for k in [1, 1, 1, 2, 2, 3, None, None]], "load_id long")


def test_not_null_and_unique(keys):
    assert not_null(keys).count() == 2
    assert {tuple(row) for row in unique(keys).collect()} == {(1, 3), (2, 2)}
    assert {tuple(row) for row in key_tests(keys).collect()} == {("not_null", 2), ("unique", 2)}
    assert {tuple(row) for row in key_tests(keys.limit(0)).collect()} == {("not_null", 0), ("unique", 0)}


def test_unique_over_several_columns(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (1, None), (1, None)], "k long, v string")
    assert [tuple(row) for row in unique(df, "k", "v").collect()] == [(1, "a", 2)]


def test_require_unique(keys):
    with pytest.raises(KeyNotUnique, match="2 values"):
        require_unique(keys)
    require_unique(keys.where("load_id IS NULL OR load_id = 3"))


def test_duplicate_profile_and_fan_out(keys):
    profile = [tuple(row) for row in duplicate_profile(keys).collect()]
    assert profile == [(1, 3), (None, 2), (2, 2), (3, 1)]
    assert len(duplicate_profile(keys, top=2).collect()) == 2
    assert len(duplicate_profile(keys, top=None).collect()) == 4
    assert {tuple(row) for row in fan_out(keys).collect()} == {(1, 3, 3.0**6), (2, 2, 64.0)}


def test_parse_failures(spark):
    texts = ["1/2/2024 9:05", "1/2/2024 9:05:33", "x", "", "  ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {row.t for row in parse_failures(df, "t").collect()} == {"1/2/2024 9:05:33", "x"}
    both = df.withColumn("u", F.lit("1/2/2024 9:05"))
    assert {tuple(row) for row in parse_failure_counts(both, ["t", "u"]).collect()} == {("t", 2), ("u", 0)}


def test_conforms(spark, loads):
    assert {row.status for row in conforms(loads, STAGED).collect()} == {"ok"}
    odd = loads.drop("pnl").withColumns(
        {
            "note": F.lit("n"),
            "carrier_rating": F.when(F.col("load_id") < 3, "high").otherwise("3"),
            "vip_carrier": F.lit(1.5),
            "quote_date": F.lit(True),
        }
    )
    got = {row.column_name: row for row in conforms(odd, STAGED).collect() if row.status != "ok"}
    assert {name: (row.status, row.misfits) for name, row in got.items()} == {
        "pnl": ("missing", 5),
        "note": ("extra", 0),
        "carrier_rating": ("mistyped", 2),
        "vip_carrier": ("mistyped", 5),
        "quote_date": ("mistyped", 5),
    }
    assert (got["pnl"].declared_type, got["pnl"].found_type) == ("double", None)


def test_contract_covers_the_published_types():
    counts = {}
    for field in STAGED:
        counts[type(field.dataType)] = counts.get(type(field.dataType), 0) + 1
    assert counts == {
        T.LongType: 1, T.IntegerType: 2, T.StringType: 6, T.TimestampNTZType: 7, T.DoubleType: 4, T.BooleanType: 12,
    }
    assert all(field.metadata["comment"] for field in STAGED)


def test_cluster_settings():
    small = settings_for(10 << 30, cores=400)
    assert small["spark.sql.shuffle.partitions"] == "400"
    assert settings_for(10 << 40, cores=4000)["spark.sql.shuffle.partitions"] == "40960"
    assert settings_for(100 << 40, cores=4000)["spark.sql.shuffle.partitions"] == "409600"


def test_numbers_that_lose_digits_are_misfits(spark):
    odd = spark.createDataFrame([(3.7, 9007199254740993), (4.0, 5)], "a double, b long")
    wanted = T.StructType().add("a", "integer").add("b", "double")
    assert {row.column_name: row.misfits for row in conforms(odd, wanted).collect()} == {"a": 1, "b": 1}
