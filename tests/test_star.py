import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from freight.contract import COMMENTS, DIMENSIONS, FACT, FACT_COLUMNS, FACT_SOURCES, KEY, STAGED
from freight.operators import KeyNotUnique, build_dimensions, build_fact
from freight.plans import materialise_star

from .conftest import rows_of


def brute_force_fact(rows):
    """Five left joins, spelled out over Python rows."""
    slices = {
        d: [tuple(row[c] for c in [KEY, *columns]) for row in rows] for d, columns in FACT_SOURCES.items()
    }
    found = []
    for row in rows:
        matches = []
        for d, columns in FACT_SOURCES.items():
            hits = [s[1:] for s in slices[d] if row[KEY] is not None and s[0] == row[KEY]]
            matches.append(hits or [(None,) * len(columns)])
        for parts in itertools.product(*matches):
            found.append((row[KEY], *itertools.chain(*parts)))
    return sorted(map(repr, found))


def with_repeats(loads):
    """Copies of load 1 that differ in every slice, and two rows without a key."""
    copy = loads.where(F.col(KEY) == 1).withColumns(
        {"book_price": F.lit(99.0), "pnl": F.lit(-1.0), "carrier_rating": F.lit(7)}
    )
    unkeyed = loads.where(F.col(KEY) >= 4).withColumn(KEY, F.lit(None).cast("long"))
    return loads.unionByName(copy).unionByName(unkeyed)


def test_dimensions_have_the_declared_columns(loads):
    dimensions = build_dimensions(loads)
    assert {name: df.columns for name, df in dimensions.items()} == DIMENSIONS
    assert dimensions["dim_delivery"].where(F.col(KEY) == 3).first().delivery_state is None


def test_fact_by_joins_on_copies_and_missing_keys(loads):
    rows = with_repeats(loads)
    fact = build_fact(rows, mode="join")
    assert fact.columns == FACT_COLUMNS
    assert fact.count() == 2**6 + 4 + 2
    assert rows_of(fact) == brute_force_fact(rows.collect())


def test_counted_fact_names_every_row_of_the_joins(loads):
    rows = with_repeats(loads)
    counted = {repr(tuple(row)[:-1]): row.copies for row in build_fact(rows, mode="counted").collect()}
    joined = Counter(brute_force_fact(rows.collect()))
    assert counted == {row: float(n) for row, n in joined.items()}


def test_counted_fact_of_many_copies(loads):
    many = loads.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("i")
    fact = build_fact(many, mode="counted")
    assert {(row[KEY], row.copies) for row in fact.collect()} == {(k, 50.0**6) for k in range(1, 6)}


def test_three_plain_copies_and_a_missing_key(spark):
    keys = spark.createDataFrame([(1,), (1,), (None,)], "load_id long")
    loads = keys.select(KEY, *[F.lit(None).cast(f.dataType).alias(f.name) for f in STAGED if f.name != KEY])
    assert build_fact(loads, mode="join").count() == 64 + 1


def test_single_equals_join_when_no_key_repeats(loads):
    unkeyed = loads.where(F.col(KEY) >= 4).withColumn(KEY, F.lit(None).cast("long"))
    rows = loads.unionByName(unkeyed)
    assert rows_of(build_fact(rows, mode="single")) == rows_of(build_fact(rows, mode="join"))


def test_single_refuses_repeated_keys(loads):
    with pytest.raises(KeyNotUnique):
        build_fact(loads.unionAll(loads), mode="single")
    with pytest.raises(ValueError):
        build_fact(loads, build_dimensions(loads), mode="single")
    with pytest.raises(ValueError):
        build_fact(loads, mode="other")


def test_given_dimensions_are_joined(loads):
    dimensions = build_dimensions(loads.where(F.col(KEY) < 3))
    fact = {row[KEY]: row for row in build_fact(loads, dimensions, mode="join").collect()}
    assert fact[2].book_price == 20.0
    assert fact[5].mileage is None


@pytest.mark.parametrize("mode", ["single", "join"])
@pytest.mark.parametrize("buckets", [None, 4])
def test_materialised_star(spark, loads, tmp_path, mode, buckets):
    unkeyed = loads.where(F.col(KEY) == 4).withColumn(KEY, F.lit(None).cast("long"))
    rows = loads.unionByName(unkeyed)
    database = f"star_{mode}_{buckets}"
    star = materialise_star(rows, database, str(tmp_path / "star"), mode, buckets)
    assert set(star) == {*DIMENSIONS, FACT}
    for name, df in build_dimensions(rows).items():
        assert rows_of(star[name]) == rows_of(df)
    assert rows_of(star[FACT]) == rows_of(build_fact(rows, mode="join"))
    described = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {database}.dim_pickup").collect()}
    assert described["pickup_city"] == COMMENTS["pickup_city"]
    # a second run replaces the first
    again = materialise_star(rows, database, str(tmp_path / "star"), mode, buckets)
    assert again[FACT].count() == 6


def test_materialise_writes_nothing_when_the_key_repeats(spark, loads, tmp_path):
    with pytest.raises(KeyNotUnique):
        materialise_star(loads.unionAll(loads), "star_repeated", str(tmp_path / "star"))
    assert not (tmp_path / "star").exists()
