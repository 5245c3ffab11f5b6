"""Partitions of a registered table, from what the writes report."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freight.plans import ingest
from freight.sinks import write_partitioned
from freight.sources import Written, register_table

from .conftest import rows_of

SCHEMA = T.StructType().add("n", "long").add("day", "string")
AWKWARD = ["2024-05-01", None, "a b/c:d%e", "it's", 'say "x"', "back\\slash", "ünï", "x=y", "{a}"]


def days(spark, *values):
    return spark.createDataFrame([(i, value) for i, value in enumerate(values)], SCHEMA)


def partitions(spark, name):
    return {row.partition for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}


@pytest.fixture
def statements(spark, monkeypatch):
    """The statements that reach the session."""
    said, plain = [], spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (said.append(text), plain(text, *a, **k))[1])
    return said


@pytest.mark.parametrize("rebalance", [False, True])
def test_write_reports_its_partitions(spark, tmp_path, rebalance):
    path = str(tmp_path / "out")
    found = write_partitioned(days(spark, "a", "b", "a", "", None), path, by="day", rebalance=rebalance)
    assert found == Written(("day",), frozenset({("a",), ("b",), (None,)}), False)
    assert write_partitioned(days(spark, "c"), path, by="day", mode="static").replaced_all
    assert write_partitioned(days(spark).where("n > 5"), path, by="day").values == frozenset()


def test_only_reported_partitions_are_added_and_dropped(spark, tmp_path, statements):
    path = str(tmp_path / "lake")
    first = write_partitioned(days(spark, *AWKWARD), path, by="day")
    table = register_table(spark, "parts_awkward", path, SCHEMA, "day", written=first)
    assert rows_of(table) == rows_of(days(spark, *AWKWARD))
    repaired = spark.read.schema(SCHEMA).parquet(path)
    assert rows_of(repaired) == rows_of(table)

    more = [write_partitioned(days(spark, "new", "it's"), path, by="day"), write_partitioned(days(spark, "newer"), path, by="day")]
    table = register_table(spark, "parts_awkward", path, SCHEMA, "day", written=more)
    assert len(partitions(spark, "parts_awkward")) == len(AWKWARD) + 2
    assert table.where("day = 'it\\'s'").count() == 1

    last = write_partitioned(days(spark, "it's", "only"), path, by="day", mode="static")
    table = register_table(spark, "parts_awkward", path, SCHEMA, "day", written=last)
    assert len(partitions(spark, "parts_awkward")) == 2
    assert rows_of(table) == rows_of(days(spark, "it's", "only"))
    assert not any("MSCK" in text for text in statements)


def test_writes_count_in_their_order(spark, tmp_path):
    path = str(tmp_path / "lake")
    writes = [
        write_partitioned(days(spark, "a", "b"), path, by="day"),
        write_partitioned(days(spark, "c"), path, by="day", mode="static"),
        write_partitioned(days(spark, "d"), path, by="day"),
    ]
    register_table(spark, "parts_order", path, SCHEMA, "day", written=writes)
    assert partitions(spark, "parts_order") == {"day=c", "day=d"}


def test_many_partitions_take_few_statements(spark, tmp_path, statements):
    path = str(tmp_path / "lake")
    rows = spark.range(450).select(F.col("id").alias("n"), F.concat(F.lit("d"), "id").alias("day")).coalesce(1)
    register_table(spark, "parts_many", path, SCHEMA, "day", written=write_partitioned(rows, path, by="day"))
    assert len(partitions(spark, "parts_many")) == 450
    assert sum(text.startswith("ALTER TABLE") for text in statements) == 3


def test_another_schema_compares_the_folder(spark, tmp_path):
    path = str(tmp_path / "lake")
    first = write_partitioned(days(spark, "a"), path, by="day")
    register_table(spark, "parts_wider", path, SCHEMA, "day", written=first)
    wider = T.StructType().add("n", "long").add("note", "string").add("day", "string")
    second = write_partitioned(days(spark, "b"), path, by="day")
    found = register_table(spark, "parts_wider", path, wider, "day", written=second)
    assert {row.day for row in found.collect()} == {"a", "b"}


def test_a_write_by_other_columns_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="partitioned by"):
        other = Written(("month",), frozenset({("1",)}), False)
        register_table(spark, "parts_other", str(tmp_path), SCHEMA, "day", written=other)


def test_ingest_lists_the_folder_once(spark, tmp_path, statements):
    drop = tmp_path / "a.csv"
    drop.write_text("load_id,lane\n1,x\n")
    lake = str(tmp_path / "lake")
    ingest(spark, str(drop), lake, "2024-05-01")
    ingest(spark, str(drop), lake, "2024-05-02", table="parts_ingest")
    assert sum("MSCK" in text for text in statements) == 1
    table = ingest(spark, str(drop), lake, "2024-05-03", table="parts_ingest")
    assert sum("MSCK" in text for text in statements) == 1
    assert {row.loading_date for row in table.collect()} == {"2024-05-01", "2024-05-02", "2024-05-03"}
    table = ingest(spark, str(drop), lake, "2024-05-04", table="parts_ingest", mode="static")
    assert {row.loading_date for row in table.collect()} == {"2024-05-04"}
