"""Winnowing against plain Python."""

import hashlib
import random

import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from freight.llm import winnowing
from freight.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATTERN = winnowing.UNIT.replace("Is", "").replace(r"\s", r"[ \t\n\x0b\f\r]").replace(r"[^[ \t\n\x0b\f\r]", r"[^ \t\n\x0b\f\r")


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chain(values):
    seed = 42
    for value in values:
        seed = xxhash.xxh64_intdigest(value, seed)
    return signed(seed)


def plain(text, gram=winnowing.GRAM, window=winnowing.WINDOW):
    units = [signed(xxhash.xxh64_intdigest(u.encode(), 42)).to_bytes(8, "little", signed=True) for u in regex.findall(PATTERN, text or "")]
    if not units:
        return [], []
    if len(units) < gram:
        seed = 42
        for unit in units:
            seed = chain([signed(seed).to_bytes(8, "little", signed=True), unit])
        hashes = [seed]
    else:
        hashes = [chain(units[i : i + gram]) for i in range(len(units) - gram + 1)]
    places = []
    for i in range(max(1, len(hashes) - window + 1)):
        best = min(range(i, min(len(hashes), i + window)), key=lambda j: (hashes[j] >> 32, -j))
        if best not in places:
            places.append(best)
    return places, [hashes[j] for j in places]


def near(a, b):
    a, b = set(a[1]), set(b[1])
    return len(a & b) / len(a | b) if a | b else 1.0


def digest(p):
    return hashlib.sha256(";".join(",".join(map(str, x)) for x in p).encode()).hexdigest()


def expected(rows):
    out = []
    for i, (key, text) in enumerate(rows):
        following, text = rows[(i + 1) % len(rows)][1] or "", text or ""
        n = len(text)
        edited = text[: n - n // 4] + following[: n // 4]
        a, b, c = plain(text), plain(edited), plain(following)
        out.append((key, n, hashlib.sha256(edited.encode()).hexdigest(), digest(a), digest(b), near(a, b), near(a, c)))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    assert found(QUERIES["op3_winnowing"](spark, SF)) == expected(rows)


@pytest.mark.parametrize("ids", [[0], [5, 9], [-4, 0, 7, 10**12], list(range(40))])
def test_few_documents(spark, ids):
    rng = random.Random(len(ids))
    texts = ["", None, "one", " a b c d", "日本語の文字 と ไทย", "w" * 100, "é ñ " * 50, "x\n\ny  z"]
    rows = [(i, rng.choice(texts)) for i in ids]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("MARK", F.lit(1)).withColumn("bucket", F.lit(2))
    assert found(winnowing.edits(frame.repartition(3))) == expected(rows)


def test_nulls_and_repeats(spark):
    rows = [(None, "a b c d e"), (3, "p q r s"), (3, "p q r s"), (4, "t")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(winnowing.edits(frame)) == expected(rows)
    assert winnowing.edits(frame.limit(0)).count() == 0


def test_shared_passage_leaves_a_common_hash(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    length = winnowing.WINDOW + winnowing.GRAM - 1
    rows = []
    for i in range(40):
        passage = " " + " ".join(rng.choices(words, k=length))
        a, b = (" ".join(rng.choices(words, k=rng.randrange(30))) + passage + " " + " ".join(rng.choices(words, k=rng.randrange(30))) for _ in range(2))
        rows.append((a, b))
    frame = spark.createDataFrame(rows, "a string, b string")
    shared = frame.select(winnowing.likeness(winnowing.fingerprint(F.col("a")), winnowing.fingerprint(F.col("b"))).alias("x"))
    assert min(r.x for r in shared.collect()) > 0
