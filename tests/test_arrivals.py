"""Drops taken once, by a stored record."""

from __future__ import annotations

import logging
import os

import pytest

import freight.plans.arrivals as arrivals
from freight.contract import KEY
from freight.plans import DropGone, ingest_new_drops
from freight.sources import read_staged

FIRST, SECOND, THIRD = "2024-05-01", "2024-05-02", "2024-05-03"


class Landing:
    def __init__(self, spark, base):
        self.spark, self.drops = spark, base / "drops"
        self.lake, self.record = str(base / "lake"), str(base / "record")
        self.drops.mkdir()

    def write(self, name, *keys, header=KEY, time=None):
        path = self.drops / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(f"{row}\n" for row in (header, *keys)) if keys else "")
        if time:
            os.utime(path, (time, time))
        return path

    def run(self, date, **options):
        found = ingest_new_drops(self.spark, str(self.drops), self.lake, self.record, date, **options)
        return {row.path.rsplit("/", 1)[1]: row.status for row in found.collect()}

    def staged(self):
        rows = read_staged(self.spark, self.lake).select(KEY, "loading_date").collect()
        return sorted((row[0], row[1]) for row in rows)


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def test_nothing_is_taken_twice(landing):
    landing.write("d1/a.csv", 1, 2)
    landing.write("d1/b.csv", "x,3", header=f"lane,{KEY}")
    assert landing.run(FIRST) == {"a.csv": "taken", "b.csv": "taken"}
    assert landing.run(SECOND) == {"a.csv": "known", "b.csv": "known"}
    landing.write("d2/c.csv", 4)
    assert landing.run(THIRD) == {"a.csv": "known", "b.csv": "known", "c.csv": "taken"}
    assert landing.staged() == [(1, FIRST), (2, FIRST), (3, FIRST), (4, THIRD)]


def test_two_runs_on_one_date_keep_both_drops(landing):
    landing.write("a.csv", 1)
    landing.run(FIRST)
    landing.write("b.csv", 2)
    landing.run(FIRST)
    assert landing.staged() == [(1, FIRST), (2, FIRST)]


def test_a_changed_file_replaces_its_rows(landing):
    landing.write("a.csv", 1, 2, time=1_700_000_000)
    landing.write("b.csv", 3)
    landing.run(FIRST)
    landing.write("a.csv", 1, 5, time=1_700_000_100)
    assert landing.run(SECOND)["a.csv"] == "changed"
    assert landing.run(THIRD)["a.csv"] == "known"
    assert landing.staged() == [(1, FIRST), (3, FIRST), (5, FIRST)]


def test_a_file_that_left_is_not_lost_from_its_date(landing):
    gone = landing.write("a.csv", 1)
    landing.run(FIRST)
    gone.unlink()
    landing.write("b.csv", 2)
    with pytest.raises(DropGone, match="a.csv"):
        landing.run(FIRST)
    assert landing.staged() == [(1, FIRST)]


def test_empty_files_are_reported_and_taken_once_filled(landing, caplog):
    landing.write("a.csv", 1)
    landing.write("b.csv")
    with caplog.at_level(logging.WARNING):
        assert landing.run(FIRST) == {"a.csv": "taken", "b.csv": "empty"}
    assert "newest file is empty" in caplog.text and "b.csv" in caplog.text
    landing.write("b.csv", 2)
    assert landing.run(SECOND) == {"a.csv": "known", "b.csv": "taken"}
    assert landing.staged() == [(1, FIRST), (2, SECOND)]


def test_no_drops_at_all(landing):
    assert landing.run(FIRST) == {}
    landing.write("only.csv")
    assert landing.run(FIRST) == {"only.csv": "empty"}
    assert not os.path.exists(landing.lake)


@pytest.mark.parametrize("after_write", [False, True])
def test_a_run_that_stops_is_made_up_for(landing, monkeypatch, after_write):
    landing.write("a.csv", 1)
    plain = arrivals.ingest

    def stopped(*args, **options):
        if after_write:
            plain(*args, **options)
        raise RuntimeError("stopped")

    monkeypatch.setattr(arrivals, "ingest", stopped)
    with pytest.raises(RuntimeError):
        landing.run(FIRST)
    monkeypatch.setattr(arrivals, "ingest", plain)
    landing.write("b.csv", 2)
    assert landing.run(SECOND) == {"a.csv": "known", "b.csv": "taken"}
    assert landing.staged() == [(1, FIRST), (2, SECOND)]


def test_rejects_by_date_and_no_mode(landing, spark, tmp_path):
    landing.write("a.csv", "1,abc", "2,3", header=f"{KEY},pnl")
    landing.run(FIRST, rejects=str(tmp_path / "rejects"))
    assert spark.read.parquet(str(tmp_path / "rejects" / FIRST)).count() == 1
    with pytest.raises(ValueError, match="mode"):
        landing.run(FIRST, mode="static")
