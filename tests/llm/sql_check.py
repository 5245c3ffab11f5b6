"""Runs a query's SQL on the same tables, for comparison."""

from pathlib import Path

import duckdb


def sql_rows(folder, statement):
    with duckdb.connect() as connection:
        for path in Path(folder).glob("*.parquet"):
            connection.execute(f"create view {path.stem} as select * from '{path}'")
        result = connection.execute(statement)
        return [column[0] for column in result.description], result.fetchall()


def same(df, columns, rows):
    assert sorted(df.columns) == sorted(columns)
    mine = sorted(repr(tuple(row[c] for c in columns)) for row in df.collect())
    assert mine == sorted(map(repr, rows))
