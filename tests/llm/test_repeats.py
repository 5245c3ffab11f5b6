"""Against the definition, string by string."""

import hashlib
import random

import pyarrow as pa
import pytest

from freight.llm import repeats
from freight.llm.queries import QUERIES

SPAN = repeats.SPAN


def plain(rows):
    """rows: (id, text); id, bytes, removed, spans, digest by the definition."""
    first, out = {}, []
    rows = [(key, (text or "").encode()) for key, text in rows]
    for key, data in rows:
        rank = -(1 << 63) if key is None else key
        for i in range(len(data) - SPAN + 1):
            string = data[i : i + SPAN]
            first[string] = min(first.get(string, (rank, i)), (rank, i))
    for key, data in rows:
        rank = -(1 << 63) if key is None else key
        gone, until = bytearray(len(data)), 0
        for i in range(len(data) - SPAN + 1):
            if first[data[i : i + SPAN]] < (rank, i):
                for j in range(max(i, until), i + SPAN):
                    gone[j] = 1
                until = i + SPAN
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((key, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, repeats.digests(repeats.remove_repeats(df)).collect()), key=str)


def test_whole_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op4_repeats"](spark, "/root/testdata/sf0.001").collect()), key=str) == plain(rows)


@pytest.mark.parametrize("seed", range(3))
def test_passages_edits_and_periods(spark, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(repeats, "BYTES_AT_ONCE", 700)  # in this process only; workers use whole batches
    word = lambda: "".join(rng.choices("abcdeé ", k=rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(rng.randrange(10, 60)) for _ in range(6)]
    rows = []
    for i in range(80):
        parts = [rng.choice([text(rng.randrange(30)), rng.choice(passages), word() * rng.randrange(60)]) for _ in range(rng.randrange(6))]
        whole = "".join(parts)
        if rng.random() < 0.4 and rows:
            whole = list(rng.choice(rows)[1] or "")
            for _ in range(rng.randrange(4)):
                if whole:
                    whole[rng.randrange(len(whole))] = "Z"
            whole = "".join(whole)
        rows.append((i * 3 - 50, whole))
    rows += [(1000, None), (1001, ""), (None, passages[0] * 2), (1002, "q" * 99), (1003, "q" * 100), (1004, "q" * 5000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as tag", "2 as id", "3 as kept")
    assert found(frame.repartition(5)) == plain(rows)
    assert found(frame.limit(0)) == []


def test_repeated_rows(spark):
    a, b = "abcdefghij" * 30, "klmnopqrst" * 3
    a = "".join(f"{i}," for i in range(200))
    rows = [(5, a), (5, a), (5, b + a), (7, a), (None, None), (None, None)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


def test_pieces_of_a_long_text_equal_the_whole(monkeypatch):
    rng = random.Random(9)
    text = "".join(rng.choices("abc", k=9000)).encode()
    import numpy as np
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([0], pa.int32()), pa.array([text])], ["id", "tag", "text"])

    def starts():
        out = set()
        for part in repeats._find_runs(iter([batch])):
            place = part.column(5).to_numpy()
            for p in place:
                out |= set(range(p >> 16, (p >> 16) + (p >> 8 & 127)))
        return out

    whole = starts()
    assert whole == set(range(len(text) - SPAN + 1))
    monkeypatch.setattr(repeats, "BYTES_AT_ONCE", 1000)
    assert starts() == whole
    assert np.array_equal(repeats.sliding_least(np.array([3, 1, 2, 5, 4], np.uint64), 2), [1, 1, 2, 4])


def test_hot_bucket_of_unlike_surroundings(spark):
    rng = random.Random(9)
    some = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    line = some(70)  # shorter than a string, so only its surroundings tell runs apart
    rows = [(i, some(60) + line + some(60)) for i in range(repeats.HOT + 2500)]
    # half runs that come again in other batches, before or behind the line
    for i in range(0, 5000, 7):
        key, text = rows[i]
        rows.append((10_000 + i, some(20) + text[:-60] + some(60) if i % 2 else some(60) + text[60:] + some(20)))
    rows += [(None, rows[3][1]), (20_000, rows[5][1]), (20_001, rows[5][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    wanted = plain(rows)
    assert sum(r[2] > 0 for r in wanted) > 700
    assert found(frame) == wanted


def test_a_hot_bucket_is_never_held_whole(monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 50)
    held = []
    for name in ("_settle", "_settle_hot"):
        old = getattr(repeats, name)
        monkeypatch.setattr(repeats, name, lambda *a, old=old, name=name: held.append((name, len(a[-1]))) or old(*a))
    n = 1000
    columns = {"bucket": [3] * 10 + [7] * n + [9] * 20, "class": [1] * 10 + [i // 300 for i in range(n)] + [5] * 20, "id": list(range(n + 30)), "extra": [0] * (n + 30), "place": [5 << 16 | 3 << 8 | 10] * (n + 30)}
    whole = pa.table(columns)
    marks = pa.Table.from_batches(list(repeats._settle_runs(iter(whole.to_batches(max_chunksize=30)))))
    assert max(size for _, size in held) <= 50 + 30
    assert {name for name, _ in held} == {"_settle", "_settle_hot"}
    covered = sorted(r["id"] for r in marks.to_pylist() if r["kind"] == 0)
    leaders = {0, 10, 310, 610, 910, n + 10}
    assert covered == [i for i in range(n + 30) if i not in leaders]
    assert {r["id"] for r in marks.to_pylist() if r["kind"] > 2} == {10, 310, 610, 910}
