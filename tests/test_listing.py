"""Folders listed in tasks: the same files as by Spark's own listing."""

from __future__ import annotations

import pytest

from freight.sources import inventory
from freight.sources.files import listing, listing_in_tasks
from tests.conftest import rows_of


@pytest.fixture
def lake(tmp_path):
    root = tmp_path / "lake"
    names = ["a/x.parquet", "a/y.parquet", "a/day=2024-05-01/z.parquet", "b/deep/er/still/w.csv", "c d/\u00e4 1.csv", "top.csv"]
    names += ["a/_SUCCESS", "a/.x.parquet.crc", "a/_temporary/0/t.parquet", "b/_k=1/kept.csv", "b/part._COPYING_", "a/.hidden/h.csv"]
    for i, name in enumerate(names):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * (i + 1))
    (root / "b" / "empty.csv").touch()
    (root / "nothing").mkdir()
    return str(root)


def test_same_rows_as_the_listing(spark, lake):
    plain = rows_of(listing(spark, lake))
    assert len(plain) == 7
    for folder in (lake, lake + "/", "file:" + lake, "file://" + lake):
        assert rows_of(listing_in_tasks(spark, folder)) == plain


def test_same_inventory(spark, lake):
    assert rows_of(inventory(spark, lake, in_tasks=True)) == rows_of(inventory(spark, lake))


def test_empty_and_missing_folders(spark, lake):
    assert listing_in_tasks(spark, lake + "/nothing").count() == 0
    with pytest.raises(Exception, match="absent"):
        listing_in_tasks(spark, lake + "/absent").count()


def test_many_folders_are_spread_over_tasks(spark, tmp_path):
    for i in range(200):
        path = tmp_path / f"f{i}" / "x.csv"
        path.parent.mkdir()
        path.write_bytes(b"1")
    found = listing_in_tasks(spark, str(tmp_path))
    assert found.count() == 200
    written = {row.name for row in found.selectExpr("_metadata.file_name as name").distinct().collect()}
    assert len(written) > 4
