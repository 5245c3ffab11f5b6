"""Keys that hold a large part of all rows."""

import pytest
from pyspark.sql import functions as F

from freight.contract import KEY, STAGED
from freight.operators import SALT, build_dimensions, build_fact, hot_keys, join_salted, repeat_hot, spread
from freight.plans import materialise_salted_fact

from .conftest import rows_of
from .test_plans import plan_of


@pytest.fixture
def skewed(spark, tmp_path):
    """3,000 stored loads: a third have the key 7, two fifths of the rest the key 8, some none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 5 < 2, 8).when(F.col("id") % 50 == 4, None).otherwise(F.col("id") + 100).cast("long")
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in STAGED if f.name not in (KEY, "book_price")]
    rows = spark.range(0, 3000, 1, 6).select(key.alias(KEY), (F.col("id") / 2).alias("book_price"), *columns).select(*STAGED.names)
    rows.write.parquet(str(tmp_path / "skewed"))
    return spark.read.schema(STAGED).parquet(str(tmp_path / "skewed"))


def one_row_a_key(rows):
    return rows.where(F.col(KEY).isNotNull()).dropDuplicates([KEY])


def test_hot_keys(skewed):
    found = {r[KEY]: r.salts for r in hot_keys(skewed, parts=20).collect()}
    n = skewed.where(f"{KEY} is not null").count()
    sizes = {key: skewed.where(f"{KEY} = {key}").count() for key in (7, 8)}
    assert found == {key: -(-size * 20 // n) for key, size in sizes.items()}
    assert hot_keys(skewed, parts=2).count() == 0
    assert hot_keys(skewed.limit(0), parts=2).count() == 0


def test_rows_are_spread_and_repeated(skewed):
    hot = hot_keys(skewed, parts=20)
    sides = spread(skewed.select(KEY), hot)
    counts = {(r[KEY], r[SALT]): r["count"] for r in sides.groupBy(KEY, SALT).count().collect()}
    own = [n for (key, _), n in counts.items() if key == 7]
    salts = hot.where(f"{KEY} = 7").first().salts
    assert len(own) == salts > 5 and max(own) - min(own) <= 6 and sum(own) == 1000  # even within each of the 6 files
    assert {salt for (key, salt) in counts if key not in (7, 8)} == {0}
    again = repeat_hot(one_row_a_key(skewed), hot)
    assert again.where(f"{KEY} = 7").count() == salts and again.where(f"{KEY} > 8").groupBy(KEY).count().where("count > 1").count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_rows_as_the_plain_join(skewed, how):
    hot = hot_keys(skewed, parts=20)
    left, right = skewed.select(KEY, "book_price"), one_row_a_key(skewed).where(f"{KEY} % 2 = 1").select(KEY, F.lit("r").alias("r"))
    salted = join_salted(spread(left, hot), repeat_hot(right, hot), how=how).drop(SALT)
    assert rows_of(salted) == rows_of(left.join(right, KEY, how))
    with pytest.raises(ValueError):
        join_salted(left, right, how="full")


def test_fact_with_hot_keys(skewed, tmp_path):
    dimensions = build_dimensions(one_row_a_key(skewed).withColumn("pnl", F.col(KEY) * 1.5))
    wanted = rows_of(build_fact(skewed, dimensions, mode="join"))
    assert rows_of(build_fact(skewed, dimensions, mode="join", hot_parts=20)) == wanted
    fact = materialise_salted_fact(skewed, dimensions, "star_salted", str(tmp_path / "star"), buckets=16)
    assert rows_of(fact.drop(SALT)) == wanted
    again = materialise_salted_fact(skewed, dimensions, "star_salted", str(tmp_path / "star"), buckets=16)
    assert rows_of(again.drop(SALT)) == wanted


def test_a_third_of_the_rows_spread_over_tasks_without_a_shuffle(spark, skewed, tmp_path):
    dimensions = build_dimensions(one_row_a_key(skewed))
    materialise_salted_fact(skewed, dimensions, "star_hot", str(tmp_path / "star"), buckets=16)
    keys = spark.table("star_hot.fact_keys")
    part = F.regexp_extract(F.input_file_name(), r"_(\d{5})", 1)
    sizes = [r["count"] for r in keys.where(f"{KEY} = 7").groupBy(part.alias("bucket")).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 0.5 * sum(sizes)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_salted(keys, spark.table("star_hot.dim_book_salted"), how="left")
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
