"""Time pairs of plans that give the same rows: the shape written out step by step, and ours.

    SHAPES_DIR=/root/testdata/sf0.1 python -m workload.shapes
"""

from __future__ import annotations

import os
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from freight.contract import DATE_COLUMNS, LOAD_DATE, RAW_DATE_FORMAT
from freight.operators import build_fact, dedupe, flatten_star, last_period
from freight.plans import last_month_report, stage
from freight.sinks import write_partitioned
from freight.sources import read_csv
from freight.workspace import shared_folder
from workload.fixtures import LOAD_DATE as DAY
from workload.fixtures import raw_drop, staged, star

SF_DIR = os.environ.get("SHAPES_DIR", "/root/testdata/sf0.1")


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def inferred_ingest(spark: SparkSession) -> None:
    df = read_csv(spark, raw_drop(spark, SF_DIR), schema=None)
    for name in DATE_COLUMNS:
        df = df.withColumn(name, F.try_to_timestamp(F.trim(name), F.lit(RAW_DATE_FORMAT)))
    df.withColumn(LOAD_DATE, F.lit(DAY)).write.partitionBy(LOAD_DATE).parquet(shared_folder(spark, "shape"))


def declared_ingest(spark: SparkSession) -> None:
    rows = stage(read_csv(spark, raw_drop(spark, SF_DIR)), DAY)
    write_partitioned(rows, shared_folder(spark, "shape"))


def month_through_the_driver(spark: SparkSession) -> None:
    flat = flatten_star(star(spark, SF_DIR))
    latest = flat.agg(F.max("delivery_date")).select(F.add_months(F.max("max(delivery_date)"), -1)).first()[0]
    month = F.date_trunc("month", F.lit(latest))
    noop(flat.where(F.date_trunc("month", "delivery_date") == month).dropDuplicates())


def twice(spark: SparkSession) -> dict:
    return {name: df.unionAll(df) for name, df in star(spark, SF_DIR).items()}


PAIRS = {
    "ingest a drop": {
        "types inferred, a column at a time": inferred_ingest,
        "declared contract, one projection": declared_ingest,
    },
    "fact": {
        "five left joins": lambda s: noop(build_fact(staged(s, SF_DIR), mode="join")),
        "one projection, key checked first": lambda s: noop(build_fact(staged(s, SF_DIR))),
        "one projection, key already checked": lambda s: noop(build_fact(staged(s, SF_DIR), verify=False)),
    },
    "flat star": {
        "plain tables": lambda s: noop(flatten_star(star(s, SF_DIR))),
        "tables bucketed by key": lambda s: noop(flatten_star(star(s, SF_DIR, bucketed=True))),
    },
    "last month's report": {
        "latest date of the joined rows, through the driver": month_through_the_driver,
        "latest date by subquery on the joined rows": lambda s: noop(
            dedupe(last_period(flatten_star(star(s, SF_DIR)), mode="calendar_month"))
        ),
        "keys profiled, tables plain": lambda s: noop(
            last_month_report(star(s, SF_DIR), "calendar_month")
        ),
        "keys checked, tables plain": lambda s: noop(
            last_month_report(star(s, SF_DIR), "calendar_month", keys_checked=True)
        ),
        "keys checked, tables bucketed": lambda s: noop(
            last_month_report(star(s, SF_DIR, bucketed=True), "calendar_month", keys_checked=True)
        ),
    },
    "report over tables delivered twice": {
        "join, then drop copies": lambda s: noop(
            dedupe(last_period(flatten_star(twice(s)), mode="calendar_month"))
        ),
        "drop copies, then join": lambda s: noop(last_month_report(twice(s), "calendar_month")),
    },
}


def main() -> None:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-shapes-"))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    star(spark, SF_DIR)
    star(spark, SF_DIR, bucketed=True)
    for pair, shapes in PAIRS.items():
        for shape, run in shapes.items():
            times = []
            for _ in range(3):
                start = time.perf_counter()
                run(spark)
                times.append(time.perf_counter() - start)
            print(f"| {pair} | {shape} | {sorted(times)[1]:.2f} |", flush=True)


if __name__ == "__main__":
    main()
