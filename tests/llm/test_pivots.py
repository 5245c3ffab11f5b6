"""Exact search against plain Python and SQL."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from freight.llm import pivots
from freight.llm.queries import ORACLES, QUERIES
from tests.llm.sql_check import same, sql_rows


@pytest.mark.parametrize("sf", ["0.001", "0.1"])
def test_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    same(QUERIES["op10_pivots"](spark, folder), *sql_rows(folder, ORACLES["op10_pivots"]))


def plain(rows, k=20, scale=64):
    good = {}
    for key, vector in rows:
        if key is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(x * scale) for x in vector]
        good[key] = min(good.get(key, whole), whole)
    out = []
    for q in good:
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(good[q], v)), key) for key, v in good.items() if key != q)
            out += [(q, i + 1, key, -score) for i, (score, key) in enumerate(scores[:k])]
    return sorted(out)


def search(df):
    return sorted(map(tuple, pivots.top_inner_products(df, F.col("vec_id") % 20 == 0, 20, 64).collect()))


def test_odd_vectors_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(pivots, "CANDIDATES", 16)
    monkeypatch.setattr(pivots, "QUERIES", 2)
    monkeypatch.setattr(pivots, "PIVOTS", 4)
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(5)]) for i in range(100)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5, 0.5]) for i in range(100, 150)]  # ties
    rows += [(160, None), (161, [1.0, None, 0.0]), (162, [float("nan")]), (163, [float("inf"), 1.0]), (None, [1.0]), (180, []), (181, [3.0]), (200, [0.0] * 5)]
    rows += [rows[3], (5, [9.0, 9.0]), (20, [-5.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as query", "3 as block")
    assert search(frame) == plain(rows)
    assert search(frame.limit(0)) == []
    assert search(frame.where("vec_id = 20")) == []
    with pytest.raises(ValueError):
        search(spark.createDataFrame([(20, [1e30])], "vec_id long, embedding array<double>"))


def test_far_blocks_are_left_out():
    """Around far centres, a query scores few groups of its own centre and none of another's block."""
    rng = np.random.default_rng(3)
    centres = np.eye(4, 16) * 400
    vectors = np.floor(np.repeat(centres, 600, axis=0) + rng.normal(0, 12, (2400, 16)))
    radius2 = float((vectors**2).sum(axis=1).max())
    raised = pivots._raised(vectors, radius2, True)
    chosen = pivots._pick(raised, 8)
    asked = vectors[::100]
    queries = {"ids": np.arange(0, 2400, 100), "vectors": asked, "squares": (asked**2).sum(axis=1)}
    queries["distances"] = pivots._distances(pivots._raised(asked, radius2, False), chosen).astype(np.float32)
    exact = asked @ vectors.T
    exact[np.arange(len(asked)), queries["ids"]] = -np.inf
    known = np.sort(exact, axis=1)[:, -5]
    for block in range(4):
        some = np.arange(600 * block, 600 * block + 600)
        distances = pivots._distances(raised[some], chosen).astype(np.float32)
        order = np.argsort(distances.min(axis=1), kind="stable")
        candidates = {"ids": some[order], "vectors": vectors[some][order], "distances": distances[order]}
        best, which, scored = pivots.search_block(queries, candidates, known, radius2, 5)
        own = queries["ids"] // 600 == block
        assert scored <= own.sum() * 600
        for i in np.flatnonzero(own):
            wanted = sorted((-exact[i, j], j) for j in some)[:5]
            assert [(-s, j) for s, j in zip(best[i], which[i]) if s >= known[i]] == [w for w in wanted if -w[0] >= known[i]]
        assert not np.isfinite(best[~own]).any()
