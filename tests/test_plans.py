"""The shape of the physical plans."""

import pytest
from pyspark.sql import functions as F

from freight.contract import FACT, KEY
from freight.operators import build_dimensions, build_fact, flatten_star, last_period
from freight.plans import last_month_report, materialise_star
from freight.sinks import write_partitioned
from freight.sources import read_staged
from freight.sources.files import listing


@pytest.fixture
def sorted_joins(spark):
    """Small test tables would all be broadcast; large ones are not."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def staged(spark, loads, tmp_path):
    write_partitioned(loads, str(tmp_path / "staged"))
    return read_staged(spark, str(tmp_path / "staged"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_single_fact_is_one_scan_without_shuffle(staged):
    plan = plan_of(build_fact(staged, mode="single"))
    assert plan.count("FileScan") == 1
    assert "Exchange" not in plan and "Join" not in plan
    assert "lane" not in plan.split("ReadSchema")[1]


def test_joined_fact_prunes_columns_and_keeps_missing_keys_out_of_the_joins(staged, sorted_joins):
    plan = plan_of(build_fact(staged, mode="join"))
    assert plan.count("SortMergeJoin") == 5
    assert plan.count("Exchange hashpartitioning") == 6
    # six join inputs that exclude missing keys, and one scan for the rows without a key
    assert plan.count("PushedFilters: [IsNotNull(load_id)]") == 6
    assert plan.count("PushedFilters: [IsNull(load_id)]") == 1
    assert "shipper_name" not in plan and "lane" not in plan


def test_dimension_is_one_projection(staged):
    for df in build_dimensions(staged).values():
        plan = plan_of(df)
        assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_bucketed_star_joins_without_shuffle(staged, tmp_path, sorted_joins):
    star = materialise_star(staged, "star_plans", str(tmp_path / "star"), buckets=4)
    plan = plan_of(flatten_star(star))
    assert plan.count("SortMergeJoin") == 5 and "Exchange" not in plan
    report = plan_of(last_month_report(star, "calendar_month", keys_checked=True))
    assert "Exchange hashpartitioning(load_id" not in report


def test_report_filters_deliveries_in_the_scan_and_before_every_join(staged, tmp_path, sorted_joins):
    star = materialise_star(staged, "star_report", str(tmp_path / "star"))
    report = last_month_report(star, "calendar_month", keys_checked=True)
    lines = plan_of(report).splitlines()
    scan = next(line for line in lines if "FileScan" in line and "delivery_city" in line)
    assert "(delivery_date" in scan.split("DataFilters:")[1]
    # deliveries are the left input of the deepest join: its line comes before all other tables
    order = [name for line in lines for name in ("delivery_city", "shipper_name", "carrier_name", "pickup_city")
             if "FileScan" in line and name in line]
    assert order[0] == "delivery_city"


def test_last_period_runs_no_job_on_the_driver(spark, staged):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("last-period", "planning only")
    try:
        last_period(staged, "delivery_date", "calendar_month")
        flatten_star({**build_dimensions(staged), FACT: build_fact(staged, mode="join")})
        assert list(tracker.getJobIdsForGroup("last-period")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_copies_are_merged_before_the_shuffle(staged, sorted_joins):
    star = {**build_dimensions(staged), FACT: build_fact(staged, mode="single", verify=False)}
    twice = {name: df.unionAll(df) for name, df in star.items()}
    plan = plan_of(flatten_star(twice, distinct=True))
    # each table: partial aggregate, exchange on the key, final aggregate, join
    assert plan.count("HashAggregate") >= 12
    assert plan.count("Exchange hashpartitioning") == 6
    joined = plan_of(flatten_star(twice).select(KEY))
    assert joined.count("HashAggregate") == 0


def test_listing_reads_only_file_status_and_packs_files(spark, tmp_path):
    folder = str(tmp_path / "many")
    spark.range(6400).repartition(64).write.parquet(folder)
    files = listing(spark, folder)
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan_of(files)
    assert files.count() == 64
    assert files.rdd.getNumPartitions() < 64
    assert files.sparkSession is spark


def test_filter_on_a_stored_value_reaches_the_scan(staged):
    plan = plan_of(staged.where((F.col("loading_date") == "2024-05-01") & (F.col("pnl") > 1)))
    assert "PartitionFilters: [isnotnull(loading_date" in plan
    assert "GreaterThan(pnl,1.0)" in plan
