"""Mixing: deviation below one block, whole results, and the same rows as SQL."""

from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from freight.llm import mixing
from freight.llm.queries import ORACLES, QUERIES
from tests.llm.sql_check import same, sql_rows


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=12))
def test_period_deviates_by_less_than_a_block(weights):
    total, slots = sum(weights), mixing.period(weights)
    assert sorted(s for own in slots for s in own) == list(range(total))
    for w, own in zip(weights, slots, strict=True):
        done = 0
        for t in range(total + 1):
            assert abs(done - Fraction(w * t, total)) < 1
            done += t in own


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    same(QUERIES["op8_mixing"](spark, folder), *sql_rows(folder, ORACLES["op8_mixing"]))


def test_shares_in_every_prefix(spark):
    counts = {"a": 700, "b": 90, "c": 33, "": 8}
    weights = {"a": 2, "b": 3, "c": 4, "": 1}
    rows = [(i, f"text {i % 7}", s or None, 1) for s, n in counts.items() for i in range(n)] + [(None, None, "a", 2)] * 5
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, mix_slot int")
    frame = frame.selectExpr("*", "1 as key", "2 as nth", "3 as hash", "4 as block", "5 as base")
    found = mixing.mix(frame, weights, block_rows=4).collect()
    assert len(found) == len(rows)
    places = Counter((r.mix_slot, r.mix_row) for r in found)
    assert max(places.values()) == 1
    order = {}
    for r in found:
        order.setdefault(r.mix_slot, set()).add(r.source or "")
    assert sorted(order) == list(range(len(order))) and all(len(s) == 1 for s in order.values())
    left = {s: -(-n // 4) for s, n in Counter(r.source or "" for r in found).items()}
    done, t = Counter(), 0
    for slot in range(len(order)):
        (source,) = order[slot]
        done[source] += 1
        left[source] -= 1
        t += 1
        total = sum(w for s, w in weights.items() if left[s] + done[s] > 0)
        for s in weights:
            if left[s] + done[s] > 0:
                assert abs(done[s] - Fraction(weights[s] * t, total)) < 1
        if not left[source]:
            done, t = Counter(), 0
            left = {s: n for s, n in left.items()}


def plain(blocks, weights):
    """Source and block of each slot, one slot after another."""
    left, order = dict(sorted(blocks.items())), []
    taken = dict.fromkeys(left, 0)
    while left:
        total, done, t = sum(weights[s] for s in left), dict.fromkeys(left, 0), 0
        while all(left.values()):
            ready = [(-(-(done[s] + 1) * total // weights[s]), s) for s in left if done[s] * total // weights[s] <= t]
            source = min(ready)[1]
            order.append((source, taken[source]))
            done[source], taken[source], left[source], t = done[source] + 1, taken[source] + 1, left[source] - 1, t + 1
        left = {s: n for s, n in left.items() if n}
    return order


@pytest.mark.parametrize("at_once", [mixing.ROWS_AT_ONCE, 2000])
def test_1500_sources(spark, monkeypatch, at_once):
    monkeypatch.setattr(mixing, "ROWS_AT_ONCE", at_once)
    counts = {f"site{i:04}": 1 + i % 3 for i in range(1500)} | {"site0007": 2000}
    rows = [(i, f"text {i % 5}", s) for s, n in counts.items() for i in range(n)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), block_rows=2).collect()
    assert len(found) == len(rows)
    order = plain({s: -(-n // 2) for s, n in counts.items()}, mixing.flattened_weights(counts))
    assert {(r.mix_slot, r.source) for r in found} == {(slot, source) for slot, (source, _) in enumerate(order)}
    assert len({(r.mix_slot, r.mix_row) for r in found}) == len(rows)


@pytest.mark.parametrize("repeats", [mixing.REPEATS_AT_ONCE, 2])
def test_stored_schedule_gives_the_same_rows(spark, monkeypatch, repeats):
    monkeypatch.setattr(mixing, "ROWS_AT_ONCE", 0)
    monkeypatch.setattr(mixing, "REPEATS_AT_ONCE", repeats)
    folder = "/root/testdata/sf0.001"
    same(QUERIES["op8_mixing"](spark, folder), *sql_rows(folder, ORACLES["op8_mixing"]))
    counts = {"a": 3000, "b": 90, "c": 33}
    rows = [(i, "", s) for s, n in counts.items() for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(frame, {"a": 2, "b": 1, "c": 3}, block_rows=4).collect()
    order = plain({s: -(-n // 4) for s, n in counts.items()}, {"a": 2, "b": 1, "c": 3})
    assert {(r.mix_slot, r.source) for r in found} == {(slot, source) for slot, (source, _) in enumerate(order)}
    assert len(found) == len(rows)


def test_many_buckets_and_empty(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    monkeypatch.setattr(mixing, "BUCKET_GROUP", 4)
    folder = "/root/testdata/sf0.001"
    same(QUERIES["op8_mixing"](spark, folder), *sql_rows(folder, ORACLES["op8_mixing"]))
    assert mixing.mix(spark.read.parquet(f"{folder}/documents.parquet").limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(spark.read.parquet(f"{folder}/documents.parquet"), {"src1": 1})
