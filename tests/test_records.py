"""Quoted line breaks read by many tasks, and drops whose files have headers of their own."""

from __future__ import annotations

import gzip
import random

import pytest
from pyspark.sql import types as T

from freight.contract import KEY
from freight.plans import UndeclaredColumns, ingest
from freight.sources import read_csv, read_with_drift, rejected_rows, undeclared_columns
from freight.sources.files import grouped_paths
from freight.sources.headers import headers
from freight.sources.records import csv_records

from .conftest import rows_of

SMALL = T.StructType().add("id", "long").add("name", "string").add("price", "double").add("note", "string")
PIECES = ["a", "bc", "\n", "\n\n", ",", '""', " ", "é", "x" * 30, "\r\n"]


@pytest.fixture
def chunks(spark):
    """Sets the size of a chunk."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    yield lambda size: [spark.conf.set(name, value) for name, value in zip(names, (size, "1"))]
    for name in names:
        spark.conf.unset(name)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def awkward(rng, line, rows):
    def value():
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 6)))
        return f'"{text}"' if set(text) & set('\n\r,"') or rng.random() < 0.3 else text

    lines = [f"id,name,price,note{line}"]
    for i in range(rows):
        lines.append(f"{i},{value()},{rng.choice(['1.5', 'abc', '', '2'])},{value()}{line}")
        if rng.random() < 0.05:
            lines.append(line)
    return "".join(lines)


@pytest.mark.parametrize("line", ["\n", "\r\n"])
@pytest.mark.parametrize("size", ["90", "4000", "128m"])
def test_equal_to_one_task_a_file(spark, tmp_path, chunks, line, size):
    rng = random.Random(f"{line}{size}")
    for i in range(2):
        write(tmp_path / f"f{i}.csv", awkward(rng, line, 80))
    chunks(size)
    found = read_csv(spark, str(tmp_path), SMALL, keep_rejected=True, line_breaks=True)
    plain = read_csv(spark, str(tmp_path), SMALL, multiLine=True)
    assert rows_of(found.drop("_rejected")) == rows_of(plain)
    assert {row.id for row in rejected_rows(found).collect()} <= {row.id for row in plain.collect()}


def test_a_record_over_many_chunks(spark, tmp_path, chunks):
    long = "\n".join("y" * 50 for _ in range(100))
    write(tmp_path / "a.csv", f'id,name,price,note\n1,"{long}",1,a\n2,"{long}",2,"{long}"\n3,c,,\n')
    chunks("200")
    found = read_csv(spark, str(tmp_path), SMALL, line_breaks=True).orderBy("id").collect()
    assert [tuple(row) for row in found] == [(1, long, 1.0, "a"), (2, long, 2.0, long), (3, "c", None, None)]


def test_one_file_is_read_by_many_tasks_and_shuffled_once(spark, tmp_path, chunks):
    rows = "".join(f'{i},"a\nb",1,x\n' for i in range(2000))
    path = write(tmp_path / "a.csv", "id,name,price,note\n" + rows)
    chunks("1000")
    assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 20
    assert spark.read.option("multiLine", True).csv(path).rdd.getNumPartitions() == 1
    found = csv_records(spark, path)
    assert found.count() == 2001
    found.collect()
    assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()


def shuffled_rows(plan):
    """Rows that the exchanges of an executed plan wrote."""
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        return shuffled_rows(plan.executedPlan())
    if "QueryStage" in plan.nodeName():
        return shuffled_rows(plan.plan())
    metrics, children = plan.metrics(), plan.children()
    own = metrics.apply("shuffleRecordsWritten").value() if metrics.contains("shuffleRecordsWritten") else 0
    return own + sum(shuffled_rows(children.apply(i)) for i in range(children.size()))


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_only_lines_of_records_over_two_chunks_are_shuffled(spark, tmp_path, chunks, broadcast):
    rows = "".join(f'{i},"a\nb\n\nc",1,x\n' for i in range(4000))
    path = write(tmp_path / "a.csv", "id,name,price,note\n" + rows)
    chunks("4000")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        found = csv_records(spark, path)
        assert len(found.collect()) == 4001
        pieces = spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions()
        assert pieces > 15 and shuffled_rows(found._jdf.queryExecution().executedPlan()) < 16 * pieces < 16_001 / 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("batch", ["1", "2", "7"])
def test_records_over_many_batches(spark, tmp_path, chunks, batch):
    rng = random.Random(batch)
    for i in range(3):
        write(tmp_path / f"f{i}.csv", awkward(rng, "\n", 60))
    chunks("700")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = rows_of(read_csv(spark, str(tmp_path), SMALL, line_breaks=True))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == rows_of(read_csv(spark, str(tmp_path), SMALL, multiLine=True))


def test_edges(spark, tmp_path):
    write(tmp_path / "empty.csv", "")
    write(tmp_path / "blank.csv", "\n\n")
    write(tmp_path / "header.csv", "id,name,price,note\n")
    write(tmp_path / "no_end.csv", '\n\nid,name,price,note\n1,"a\nb",,"c\n"')
    write(tmp_path / "open.csv", 'id,name,price,note\n2,x,1,y\n3,"never\n4,closed')
    with gzip.open(tmp_path / "packed.csv.gz", "wb") as out:
        out.write(b'id,name,price,note\n5,"p\nq",1,r\n')
    found = read_csv(spark, str(tmp_path), SMALL, line_breaks=True).orderBy("id").collect()
    assert [row.id for row in found] == [1, 2, 3, 5]
    assert [row.name for row in found] == ["a\nb", "x", "never\n4,closed", "p\nq"]


def test_breaks_in_the_header_and_names(spark, tmp_path):
    write(tmp_path / "a.csv", '"no\nte",ID,extra\n"x\ny",1,"e\n"\nz,2,\n')
    found = read_csv(
        spark, str(tmp_path), SMALL, by_name=True, rename={"no\nte": "note"}, keep_undeclared=True, line_breaks=True
    )
    assert found.columns == [*SMALL.names, "extra"]
    assert [tuple(row) for row in found.orderBy("id").collect()] == [(1, None, None, "x\ny", "e\n"), (2, None, None, "z", None)]


def test_other_headers_are_an_error_with_line_breaks(spark, tmp_path):
    write(tmp_path / "a.csv", "ID,Name,price,note\n1,x,2,y\n")
    assert read_csv(spark, str(tmp_path), SMALL, line_breaks=True).count() == 1
    for header in ("name,id,price,note", "id,name,price", "id,name,price,note,more"):
        write(tmp_path / "b.csv", f"{header}\n1,x,2,y\n")
        with pytest.raises(ValueError, match="header does not conform"):
            read_csv(spark, str(tmp_path), SMALL, line_breaks=True)


def test_without_a_header(spark, tmp_path):
    write(tmp_path / "a.csv", '1,"a\nb",2,c\n2,d,,\n')
    found = read_csv(spark, str(tmp_path), SMALL, line_breaks=True, header=False)
    assert {row.name for row in found.collect()} == {"a\nb", "d"}


# -- files with headers of their own -------------------------------------------


@pytest.fixture
def mixed(tmp_path):
    write(tmp_path / "drop" / "a.csv", "id,name,price,note\n1,x,2,y\n")
    write(tmp_path / "drop" / "b.csv", "Note,id,remark\nz,2,r\n")
    write(tmp_path / "drop" / "c.csv", "price,Remark,name,shipment,other\nabc,s,w,3,o\n")
    write(tmp_path / "drop" / "d.csv", "id,name,price,note\n4,x,2,y\n")
    write(tmp_path / "drop" / "none.csv", "\n")
    write(tmp_path / "drop" / "more" / "e.csv", "id,name,price,note\n5,x,2,y\n")
    write(tmp_path / "drop" / "more-1" / "f.csv", "name,id\nv,6\n")
    return str(tmp_path / "drop")


def test_headers_are_read_in_tasks(spark, mixed, tmp_path):
    found = {row.path.rsplit("/", 1)[1]: row.header for row in headers(spark, mixed).collect()}
    assert found["c.csv"] == "price,Remark,name,shipment,other" and found["none.csv"] is None
    long = '"' + "h\n" * 100_000 + '",b'
    with gzip.open(tmp_path / "long.csv.gz", "wb") as out:
        out.write(("﻿\r\n" + long + "\r\n1,2\r\n").encode())
    write(tmp_path / "one.csv", "no_end")
    rows = headers(spark, [str(tmp_path / "long.csv.gz"), str(tmp_path / "one.csv")]).orderBy("path").collect()
    assert rows[0].header == long and rows[1].header == "no_end"


@pytest.mark.parametrize("line_breaks", [False, True])
def test_mixed_headers_by_name(spark, mixed, line_breaks):
    found = read_csv(
        spark, mixed, SMALL, mixed_headers=True, rename={"shipment": "id"}, keep_rejected=True, keep_undeclared=True,
        line_breaks=line_breaks,
    )
    assert [c.lower() for c in found.columns] == [*SMALL.names, "remark", "other", "_rejected"]
    got = {row[0]: tuple(row)[1:6] for row in found.collect()}
    assert got == {
        1: ("x", 2.0, "y", None, None),
        2: (None, None, "z", "r", None),
        3: ("w", None, None, "s", "o"),
        4: ("x", 2.0, "y", None, None),
        5: ("x", 2.0, "y", None, None),
        6: ("v", None, None, None, None),
    }
    assert [row._rejected for row in rejected_rows(found).collect()] == ["abc,s,w,3,o"]


def test_only_the_files_given_are_read(spark, tmp_path):
    for name in ("a", "b", "c"):
        write(tmp_path / f"{name}.csv", f"id,name\n{ord(name)},{name}\n")
    for given in (["a"], ["a", "c"]):
        paths = [str(tmp_path / f"{name}.csv") for name in given]
        found = read_csv(spark, paths[0] if len(paths) == 1 else paths, SMALL, mixed_headers=True)
        assert sorted(row.name for row in found.collect()) == given


def test_one_scan_a_header(spark, mixed):
    plan = read_csv(spark, mixed, SMALL, mixed_headers=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 4


def test_mixed_drop_without_headers_is_empty(spark, tmp_path):
    write(tmp_path / "a.csv", "\n")
    found = read_csv(spark, str(tmp_path), SMALL, mixed_headers=True, keep_rejected=True)
    assert found.columns == [*SMALL.names, "_rejected"] and found.count() == 0
    with pytest.raises(ValueError, match="declared schema"):
        read_csv(spark, str(tmp_path), None, mixed_headers=True)


def test_ingest_mixed_headers_and_line_breaks(spark, tmp_path):
    write(tmp_path / "drop" / "a.csv", f'{KEY},lane,remark\n1,"x\ny",r\n')
    write(tmp_path / "drop" / "b.csv", f"lane,{KEY},Remark,other\nz,2,s,o\n")
    given = dict(load_date="2024-05-01", line_breaks=True, mixed_headers=True)
    drop, lake = str(tmp_path / "drop"), str(tmp_path / "lake")
    with pytest.raises(UndeclaredColumns):
        ingest(spark, drop, lake, **given)
    assert len(undeclared_columns(spark, drop, mixed_headers=True)) == 2
    found = ingest(spark, drop, lake, undeclared="keep", table="mixed.loads", **given)
    rows = [(row.load_id, row.lane, row.remark, row.other) for row in found.orderBy(KEY).collect()]
    assert rows == [(1, "x\ny", "r", None), (2, "z", "s", "o")]


def test_a_folder_below_another_is_told_apart(spark, tmp_path):
    """``x-1`` sorts between ``x`` and ``x/y``."""
    rows = [("x/a", "1"), ("x-1/b", "1"), ("x/y/c", "2")]
    found = grouped_paths(spark.createDataFrame(rows, "path string, kind string"))
    assert {kind: sorted(paths) for kind, paths in found.items()} == {"1": ["x-1", "x/a"], "2": ["x/y"]}
    for at, (name, _) in enumerate(rows):
        kind = spark.range(1) if at < 2 else spark.range(1).selectExpr("cast(id as string) as id")
        kind.write.parquet(str(tmp_path / name.rsplit("/", 1)[0]))
    assert read_with_drift(spark, str(tmp_path)).count() == 3
