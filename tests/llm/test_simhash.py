"""Against all pairs, on small fixtures."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from freight.llm import simhash
from freight.llm.components import components
from freight.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, words=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=2):
    """prints: list of (id, fingerprint); the smallest id for each."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(prints):
        least.setdefault(root(i), []).append(key)
    return [min((k for k in least[root(i)] if k is not None), default=None) for i in range(len(prints))]


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    parent = {v: v for e in edges for v in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    found = components(spark.createDataFrame(edges, "x long, y long"), "x", "y")
    met = {v for a, b in edges if a != b for v in (a, b)}
    assert sorted(map(tuple, found.collect())) == sorted((v, root(v)) for v in met)
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


@pytest.mark.parametrize("parts", [1, 4, 8])
def test_links_in_small_tiles(spark, parts):
    rng = random.Random(parts)
    seeds = [rng.getrandbits(64) for _ in range(60)] + [0, 2**64 - 1]
    values = set(seeds)
    for seed in seeds:
        for _ in range(6):
            near = seed
            for _ in range(rng.randrange(4)):
                near ^= 1 << rng.randrange(64)
            values.add(near)
    values = sorted(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 2, parts, tile=5)
    reached = {r.vertex: r.component for r in components(edges, "a", "b").collect()}
    wanted = plain_components(list(zip(signed, values, strict=True)))
    assert [reached.get(v, v) for v in signed] == wanted


def test_query_on_the_smallest_tables(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in rows]
    wanted = sorted((key, f"{fp:016x}", c) for (key, fp), c in zip(prints, plain_components(prints), strict=True))
    assert sorted(map(tuple, QUERIES["op9_simhash"](spark, SF).collect())) == wanted


def test_odd_rows(spark):
    base = "one two three four five six seven eight"
    rows = [(5, base, "a"), (5, base, "a"), (None, base, "b"), (2, None, None), (9, "  ", "c"), (4, "Word", "d"), (3, "wORD", "d"),
            (None, "alone here", "e"), (None, "alone here", "e"), (4, "x " * 70_000, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark string").withColumn("FP", F.lit(1)).withColumn("place", F.lit(2))
    found = sorted(simhash.near_duplicates(docs).collect(), key=str)
    prints = [(key, plain_fingerprint(text)) for key, text, _ in rows]
    wanted = [(key, f"{fp:016x}", c) for (key, fp), c in zip(prints, plain_components(prints), strict=True)]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, (r.text or "")[:10]) for r in kept.collect()) == [(-1, "alone here"), (2, ""), (3, "wORD"), (4, "x x x x x "), (5, base[:10])]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.representatives(docs.limit(0)).count() == 0
