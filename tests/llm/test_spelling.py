"""Spelling variants against brute force."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from freight.llm import spelling
from freight.llm.queries import QUERIES

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    """Whether one letter is inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    i = next((i for i, x in enumerate(short) if x != long[i]), len(short))
    return short[i:] == long[i + 1 :]


def plain_counts(rows, every=97):
    counts = Counter()
    for key, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= 5 and n >= 3}


def plain_variants(counts):
    # words with a common key of one deletion are the only ones that can be near
    keys = {}
    for word in counts:
        for key in {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}:
            keys.setdefault(key, set()).add(word)
    found = {word: set() for word in counts}
    for words in keys.values():
        for a in words:
            found[a] |= {b for b in words if near(a, b)}
    form = {}
    for word, others in found.items():
        best = min(others, key=lambda other: (-counts[other], other), default=None)
        form[word] = best if best and counts[best] >= 2 * counts[word] else None
    rows = []
    for word in counts:
        root = word
        while form[root]:
            root = form[root]
        rows.append((word, form[word], root, counts[word], len(found[word]), counts[form[word]] if form[word] else None))
    return sorted(rows, key=str)


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    wanted = plain_variants(plain_counts(rows))
    assert rows_of(QUERIES["op12_spelling"](spark, folder)) == wanted
    assert sum(row[4] > 0 for row in wanted) > 100


def random_words(rng, n, letters):
    base = ["".join(rng.choice(list(letters), rng.integers(5, 9))) for _ in range(n)]
    edited = []
    for word in base:
        i = int(rng.integers(len(word)))
        edited += [word[:i] + word[i + 1 :], word[:i] + str(rng.choice(list(letters))) + word[i:], word[:i] + str(rng.choice(list(letters))) + word[i + 1 :]]
    return sorted({word for word in base + edited if len(word) >= 5})


@pytest.mark.parametrize("most", [spelling.FILTER_BYTES, 256])
def test_any_vocabulary(spark, most):
    """Filters too small for the vocabulary answer yes more often; the result is the same."""
    rng = np.random.default_rng(1)
    words = random_words(rng, 400, "abÿé") + ["aaaaa", "aaaaaa", "aaaaaaa"] + ["日本語日本", "日本語日本語", "x" * 60, "x" * 61, "x" * 30 + "y" + "x" * 29]
    counts = {word: int(n) for word, n in zip(words, rng.integers(3, 60, len(words)))}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.variants(frame, most=most)) == plain_variants(counts)


def test_chain_of_forms(spark):
    words = ["stone" + "s" * i for i in range(12)]
    counts = {word: 3 * 2**i for i, word in enumerate(words)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = rows_of(spelling.variants(frame))
    assert found == plain_variants(counts) and {row[2] for row in found} == {words[-1]}


def test_filters_hold_every_word():
    rng = np.random.default_rng(2)
    words = spelling.Words(random_words(rng, 3000, "abcdefgh"))
    keys = spelling.Words.keys(words.sums, words.lengths)
    filters = spelling.Filters(dict(Counter(words.lengths.tolist())))
    block, some = filters.block(keys, words.lengths)
    assert some.all()
    filters.bits = np.zeros(int(filters.blocks.sum()) * spelling.BLOCK // 64, np.uint64)
    for probe in range(spelling.PROBES):
        bit = filters.bit(keys, probe)
        np.bitwise_or.at(filters.bits, block * 8 + (bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
    assert len(filters.holds(keys, words.lengths)) == len(keys)
    others = spelling.mixed(np.arange(1, 200_000, dtype=np.uint64))
    assert len(filters.holds(others, np.full(len(others), 7))) < 0.01 * len(others)


def test_odd_rows(spark):
    long = "ab" * 30_000
    rows = [(None, "Letter letter LETTER lettr"), (None, "Letter letter LETTER lettr"), (1, None), (2, ""), (3, "lettr àÀÉéé àÀÉéé àÀÉéé ÀÀÉéé ÀÀÉéé ÀÀÉéé"), (4, "1234 !? abcd"),
            (5, f"{long} {long} {long} {long}b {long}b {long}b"), (6, "straße straße straße strasse strasse strasse strase strase strase")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'w' as word", "1 as n", "2 as id", "3 as run", "4 as key")
    assert rows_of(spelling.text_variants(frame, every=97)) == plain_variants(plain_counts(rows))
    assert rows_of(spelling.text_variants(frame, every=2)) == plain_variants(plain_counts(rows, every=2))
    assert spelling.text_variants(frame.limit(0), every=97).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(frame.select(F.col("text").alias("word"), F.lit(1).alias("n")), lead=1)
