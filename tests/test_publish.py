"""A star published as a whole: old or new, never a mixture."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from freight.contract import DIMENSIONS, FACT, KEY
from freight.plans import publish, star_schema
from freight.plans.publish import StarIncomplete, publish_star, published_star
from tests.conftest import rows_of


def keys(star):
    return {name: sorted(str(r[0]) for r in df.select(KEY).collect()) for name, df in star.items()}


@pytest.mark.parametrize("buckets", [None, 3])
def test_a_new_build_replaces_the_old_one(spark, loads, tmp_path, buckets):
    database = f"published_{buckets or 0}"
    with pytest.raises(LookupError):
        published_star(spark, database)
    publish_star(loads.where("load_id < 4"), database, str(tmp_path), buckets=buckets)
    old = published_star(spark, database)
    assert set(old) == {*DIMENSIONS, FACT} and keys(old)[FACT] == ["1", "2", "3"]
    publish_star(loads, database, str(tmp_path), buckets=buckets)
    assert set(map(tuple, keys(published_star(spark, database)).values())) == {("1", "2", "3", "4", "5")}
    # a reader of the old build still has its files
    assert keys(old)[FACT] == ["1", "2", "3"]


def test_a_build_stopped_half_way_leaves_the_old_star(spark, loads, tmp_path, monkeypatch):
    publish_star(loads.where("load_id < 4"), "stopped", str(tmp_path))
    before = {name: rows_of(df) for name, df in published_star(spark, "stopped").items()}
    save, done = star_schema.save_table, []

    def stops(df, name, *args, **kwargs):
        if len(done) == 3:
            raise RuntimeError("lost")
        done.append(name)
        return save(df, name, *args, **kwargs)

    monkeypatch.setattr(star_schema, "save_table", stops)
    with pytest.raises(RuntimeError, match="lost"):
        publish_star(loads, "stopped", str(tmp_path))
    assert len(done) == 3
    assert {name: rows_of(df) for name, df in published_star(spark, "stopped").items()} == before


def test_a_build_that_lacks_rows_is_not_published(spark, loads, tmp_path, monkeypatch):
    publish_star(loads.where("load_id < 4"), "lacking", str(tmp_path))
    build = publish.materialise_star

    def loses(*args):
        star = build(*args)
        return {**star, FACT: star[FACT].where(F.col(KEY) > 1)}

    monkeypatch.setattr(publish, "materialise_star", loses)
    with pytest.raises(StarIncomplete):
        publish_star(loads, "lacking", str(tmp_path))
    assert keys(published_star(spark, "lacking"))[FACT] == ["1", "2", "3"]


def test_joined_and_empty_loads(spark, loads, tmp_path):
    publish_star(loads.unionAll(loads.where("load_id = 1")), "joined", str(tmp_path), mode="join")
    assert published_star(spark, "joined")[FACT].count() == 4 + 2**6
    publish_star(loads.limit(0), "joined", str(tmp_path))
    assert published_star(spark, "joined")[FACT].count() == 0
