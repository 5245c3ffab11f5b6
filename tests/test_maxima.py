"""Largest values from footers: equal to an aggregate, with and without statistics."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freight.operators.report import last_period
from freight.sources.maxima import stored_maxima
from tests.conftest import rows_of

NTZ = T.TimestampNTZType()


def write(path, values, kind=pa.timestamp("us"), name="at", **options):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table({"id": list(range(len(values))), name: pa.array(values, kind)}), path, **options)


@pytest.mark.parametrize("statistics", [True, False, ["id"]])
def test_equals_the_aggregate(spark, tmp_path, statistics):
    at = dt.datetime(2024, 3, 31, 10, 30, 0, 123456)
    write(tmp_path / "a.parquet", [at, None, dt.datetime(1969, 1, 1)] * 10, row_group_size=4, write_statistics=statistics)
    write(tmp_path / "day=1" / "b.parquet", [None, None], write_statistics=statistics)
    write(tmp_path / "day=2" / "c.parquet", [], write_statistics=statistics)
    write(tmp_path / "day=3" / "d.parquet", [at - dt.timedelta(1)], write_statistics=statistics)
    found = stored_maxima(spark, str(tmp_path), "at", NTZ)
    assert found.count() == 4
    assert found.agg(F.max("at")).first()[0] == at
    assert sorted(r["at"] for r in found.collect() if r["at"]) == [at - dt.timedelta(1), at]


def test_mixed_files_lacking_column_and_nothing(spark, tmp_path):
    write(tmp_path / "t" / "a.parquet", [dt.datetime(2024, 1, 1)], write_statistics=True)
    write(tmp_path / "t" / "b.parquet", [dt.datetime(2024, 1, 2)], write_statistics=False)
    write(tmp_path / "t" / "c.parquet", [dt.datetime(2025, 1, 1)], name="other")
    write(tmp_path / "t" / "d.parquet", [dt.datetime(2024, 1, 3)], name="AT")
    assert stored_maxima(spark, str(tmp_path / "t"), "at", NTZ).agg(F.max("at")).first()[0] == dt.datetime(2024, 1, 3)
    (tmp_path / "none").mkdir()
    assert stored_maxima(spark, str(tmp_path / "none"), "at", NTZ).agg(F.max("at")).first()[0] is None
    with pytest.raises(ValueError):
        stored_maxima(spark, str(tmp_path / "t"), "at", T.StringType())


@pytest.mark.parametrize("kind, arrow", [(T.DateType(), pa.date32()), (T.LongType(), pa.int64()), (T.ByteType(), pa.int8())])
def test_other_types(spark, tmp_path, kind, arrow):
    values = [dt.date(2024, 1, 31), dt.date(1960, 1, 1)] if arrow == pa.date32() else [-5, -7]
    write(tmp_path / "a.parquet", values, arrow)
    assert stored_maxima(spark, str(tmp_path), "at", kind).first()[0] == values[0]


def test_anchor_of_a_report(spark, loads, tmp_path):
    path = str(tmp_path / "loads")
    loads.repartition(3).write.parquet(path)
    stored = spark.read.schema(loads.schema).parquet(path)
    anchor = stored_maxima(spark, path, "delivery_date", NTZ)
    for mode in ("instant", "day", "calendar_month"):
        assert rows_of(last_period(stored, mode=mode, anchor=anchor)) == rows_of(last_period(stored, mode=mode))
