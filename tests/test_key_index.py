"""Key bitmaps against the plain uniqueness check."""

import random

from pyspark.sql import functions as F

from freight.operators import key_bitmaps, overlaps, read_key_index, repeated_since, unique, update_key_index
from freight.sinks import write_partitioned

from .conftest import rows_of

DDL = "load_id long, loading_date string"


def stored(spark, tmp_path, rows):
    folder, index = str(tmp_path / "loads"), str(tmp_path / "index")
    frame = spark.createDataFrame(rows, DDL)
    write_partitioned(frame, folder)
    for day in sorted({day for _, day in rows}):
        update_key_index(frame.where(F.col("loading_date") == day), index)
    return spark.read.schema(DDL).parquet(folder), read_key_index(spark, index)


def test_equals_unique(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.randrange(200_000) - 60_000, day) for day in ("d1", "d2", "d3") for _ in range(1500)]
    rows += [(None, "d3"), (None, "d3"), (5, "d1"), (5, "d1"), (7, "d1"), (7, "d3"), (7, "d3"), (-1, "d2"), (-1, "d3"), (0, "d2"), (0, "d3"), (2**62, "d1"), (2**62, "d3"), (32768, "d3"), (32769, "d2")]
    loads, index = stored(spark, tmp_path, rows)
    for day in ("d1", "d2", "d3"):
        keys = loads.where(F.col("loading_date") == day).select("load_id").distinct()
        assert rows_of(repeated_since(loads, index, day)) == rows_of(unique(loads.select("load_id")).join(keys, "load_id", "left_semi"))
    assert repeated_since(loads, index, "d9").count() == 0


def test_old_rows_are_not_read_without_an_overlap(spark, tmp_path):
    rows = [(i, "d1") for i in range(0, 90_000, 9)] + [(i + 1, "d2") for i in range(0, 90_000, 9)]
    loads, index = stored(spark, tmp_path, rows)
    assert overlaps(index, "d2").isEmpty()
    broken = loads.withColumn("load_id", F.when(F.lit(True), F.raise_error(F.lit("read"))).cast("long"))
    found = repeated_since(broken, index, "d2")
    assert found.columns == ["load_id", "n_records"] and found.count() == 0
    # one bitmap for each date and 32,768 keys; the key 0 stands apart
    assert {tuple(r) for r in index.groupBy("loading_date").count().collect()} == {("d1", 4), ("d2", 3)}


def test_only_overlapping_dates_are_counted(spark, tmp_path):
    rows = [(i, "d1") for i in range(100)] + [(i, "d2") for i in range(40_000, 40_100)] + [(40_050, "d3"), (70_000, "d3")]
    loads, index = stored(spark, tmp_path, rows)
    assert {tuple(r) for r in overlaps(index, "d3").collect()} == {("d2", 2), ("d3", 2)}
    assert [tuple(r) for r in repeated_since(loads, index, "d3").collect()] == [(40_050, 2)]


def test_a_repeated_date_is_replaced(spark, tmp_path):
    _, index = stored(spark, tmp_path, [(1, "d1"), (2, "d2")])
    update_key_index(spark.createDataFrame([(2, "d1"), (2, "d1"), (3, "d1")], DDL), str(tmp_path / "index"))
    index = read_key_index(spark, str(tmp_path / "index"))
    assert {(r.loading_date, r.n_rows) for r in index.collect()} == {("d1", 3), ("d2", 1)}
    assert key_bitmaps(spark.createDataFrame([(None, "d1")], DDL)).count() == 0
