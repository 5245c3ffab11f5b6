"""Line windows against plain Python and SQL."""

import pytest

from freight.llm import line_windows
from freight.llm.queries import ORACLES, QUERIES
from tests.llm.sql_check import same, sql_rows


def plain(rows):
    """rows: (id, text), distinct; the kept text and the numbers of lines."""
    seen, out = set(), []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        if text is None:
            out.append((key, None, 0, 0))
            continue
        lines = text.split("\n")
        covered = set()
        for i in range(len(lines) - 2):
            window = tuple(lines[i : i + 3])
            if window in seen:
                covered |= {i, i + 1, i + 2}
            seen.add(window)
        kept = "\n".join(line for i, line in enumerate(lines) if i not in covered)
        out.append((key, kept if covered else text, len(lines), len(covered)))
    return out


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_sql(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    same(QUERIES["op5_line_windows"](spark, folder), *sql_rows(folder, ORACLES["op5_line_windows"]))


def test_odd_rows(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\nd\ny"), (3, "a\nb\nc\nd"), (4, "z\nz\nz\nz\nz"), (5, None), (6, ""), (7, "a\nb"), (8, "\n\n\n\n"),
            (None, "b\nc\nd\n"), (9, "l1\n" * 3000), (10, "x\n" + "a\nb\nc\n" * 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as N_Lines", "'m' as mark", "'c' as covered", "1 as lines", "2 as id", "3 as place")
    found = line_windows.dedup_lines(frame)
    assert found.columns == ["doc_id", "text", "mark", "covered", "lines", "id", "place", "n_lines", "n_removed"]
    got = [(r.doc_id, r.text, r.n_lines, r.n_removed) for r in found.collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)
    assert line_windows.dedup_lines(frame.limit(0)).count() == 0


def test_repeated_rows(spark):
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (1, "q\na\nb\nc"), (None, None), (None, None)]
    found = line_windows.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 5
    removed = sorted((r.text or "", r.n_removed) for r in found)
    # the two equal rows are one document; of the two texts with id 1 the one with the larger hash loses its copy
    assert removed in ([("", 0), ("", 0), ("a\nb\nc", 0), ("a\nb\nc", 0), ("q", 3)], [("", 0), ("", 0), ("", 3), ("", 3), ("q\na\nb\nc", 0)])
