from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("freight-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.checkpoint.dir", str(base / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def loads(spark):
    """A small staged table: four plain loads, one without a lane."""
    from freight.contract import STAGED

    def load(key, lane, delivery, **other):
        row = dict.fromkeys(STAGED.names)
        row.update(load_id=key, lane=lane, delivery_date=delivery, loading_date="2024-05-01", **other)
        return tuple(row[name] for name in STAGED.names)

    from datetime import datetime as at

    rows = [
        load(1, "Reno,NV -> Boise,ID", at(2024, 3, 31, 10, 30), book_price=10.0, carrier_name="a", pnl=1.0),
        load(2, "Waco,TX -> Tulsa,OK", at(2024, 2, 29), book_price=20.0, carrier_name="b", pnl=2.0),
        load(3, "Waco,TX -> Tulsa", at(2024, 2, 29, 8, 0), book_price=30.0, carrier_name="b", pnl=3.0),
        load(4, None, None, book_price=40.0),
        load(5, "Reno,NV -> Boise,ID", at(2024, 2, 1, 23, 59), shipper_name="s", mileage=5.0),
    ]
    return spark.createDataFrame(rows, STAGED)


def rows_of(df):
    """Rows as a sorted list, for comparing frames as bags."""
    return sorted(map(repr, (tuple(row) for row in df.collect())))
