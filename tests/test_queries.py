"""Every registered query against its SQL, on the smallest test tables."""

import datetime as dt
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not present")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in SF.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def _plain(value):
    if isinstance(value, dt.datetime):
        return "t" + value.isoformat()
    return f"{type(value).__name__}:{value!r}"


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sql, name):
    df = contract.queries()[name](spark, str(SF))
    result = sql.execute(contract.oracle_sql()[name])
    wanted = _bag([column[0] for column in result.description], result.fetchall())
    assert _bag(df.columns, df.collect()) == wanted


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_runs_again(spark, sql, name):
    """Once more in the session that has run all the others, with what they left behind."""
    found = contract.queries()[name](spark, str(SF)).count()
    assert found == sql.execute(f"select count(*) from ({contract.oracle_sql()[name]})").fetchone()[0]


def test_entry(spark):
    report = contract.entry(spark)
    assert report.count() == 74
    assert report.columns[0] == "load_id"
