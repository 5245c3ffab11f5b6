"""Fill-in-the-middle against plain Python and SQL."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from freight.llm import fill_middle
from freight.llm.queries import ORACLES, QUERIES
from tests.llm.sql_check import same, sql_rows


def plain(text, key, seed=7, rate=100, spm=50):
    """The definition, line by line: n, form, code points of prefix and middle, output."""
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(lines), "plain", None, None, text
    a, b = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h4 % 100 < spm:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    same(QUERIES["op13_fill_middle"](spark, folder), *sql_rows(folder, ORACLES["op13_fill_middle"]))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab\n é日😀<PSM>"), max_size=60), st.integers(0, 99), st.sampled_from([1, 2, 3, 8, 64]))
def test_any_text(text, key, block):
    output, form, n, prefix, middle = fill_middle.fill(text.encode(), str(key), block=block)
    assert (n, form, prefix, middle, output.decode()) == plain(text, key)
    assert fill_middle.unfill(output.decode(), form) == text


@pytest.mark.parametrize("block", [1, 5, 16, 4096])
def test_every_cut(block):
    text = "".join("é" * (i % 7) + "\n" * (i % 3) for i in range(200)) + "end"
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    tree = fill_middle.BlockTree(np.frombuffer(text.encode(), np.uint8), block)
    assert tree.units == len(lines) and tree.points == len(text)
    for k in range(len(lines) + 1):
        head = "".join(lines[:k])
        assert tree.cut(k) == (len(head.encode()), len(head))


def test_rates_and_marks():
    chosen = fill_middle.Settings(seed=3, rate=40, suffix_first=0, prefix="[a]", suffix="[b]", middle="[c]")
    forms = [fill_middle.fill(b"x\ny\nz", str(i), chosen) for i in range(2000)]
    assert {form for _, form, *_ in forms} == {"plain", "psm"}
    assert 0.35 < np.mean([form != "plain" for _, form, *_ in forms]) < 0.45
    assert all(fill_middle.unfill(output.decode(), form, chosen) == "x\ny\nz" for output, form, *_ in forms)
    assert fill_middle.fill(b"x[b]", "1", chosen)[1] == "plain" and fill_middle.fill(b"<P>\n", "1", fill_middle.Settings(prefix="[a]"))[1] != "plain"
    with pytest.raises(ValueError):
        fill_middle.unfill("x", "psm")


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a\nb\nc"), (None, "a\nb\nc"), (3, "\n\n\n"), (4, "x <M> y"), (5, "one"), (5, "one"), (6, "日本\n😀" * 40000), (7, "a\r\nb")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'f' as FIM", "1 as n", "'o' as output")
    found = fill_middle.fill_in_middle(frame)
    assert found.columns == ["doc_id", "text", "fim", "n", "output"]
    got = [(r.doc_id, r.fim.n, r.fim.form, r.fim.prefix_chars, r.fim.middle_chars, r.fim.output) for r in found.collect()]
    assert sorted(got, key=str) == sorted([(key, *plain(text, "" if key is None else key)) for key, text in rows], key=str)
    digests = fill_middle.digests(frame).collect()
    assert sorted(r.restored_sha256 for r in digests) == sorted(hashlib.sha256((text or "").encode()).hexdigest() for _, text in rows)
    assert fill_middle.digests(frame.limit(0)).count() == 0
