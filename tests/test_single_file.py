"""One CSV file written by many tasks."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from freight.plans import hand_over_latest_drop
from freight.sinks import CannotJoinFiles, export_csv, export_csv_file, single_file
from freight.sources import read_latest_csv, read_text_csv

from .conftest import rows_of


def many_parts(spark, n=2000, parts=7):
    rows = spark.range(0, n, 1, parts)
    text = F.when(F.col("id") % 5 == 0, F.concat(F.lit('say "hi", '), "id")).when(F.col("id") % 7 == 0, F.lit("é ü\t"))
    return rows.select("id", text.alias("text"), (F.col("id") / 3).alias("share"))


def plain_bytes(df, folder, **options):
    """What one task writes."""
    export_csv(df.coalesce(1), str(folder), **options)
    [part] = Path(folder).glob("part-*")
    return part.read_bytes()


@pytest.mark.parametrize("header", [True, False])
def test_bytes_equal_a_plain_writers(spark, tmp_path, header, monkeypatch):
    monkeypatch.setattr(single_file, "RANGE_BYTES", 1000)  # parts of several ranges
    df = many_parts(spark)
    export_csv_file(df, str(tmp_path / "out" / "loads.csv"), header=header)
    assert (tmp_path / "out" / "loads.csv").read_bytes() == plain_bytes(df, tmp_path / "plain", header=header)
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["loads.csv"]


def test_no_task_holds_the_table(spark, tmp_path):
    df = many_parts(spark)
    tasks = []
    export = single_file.export_csv

    def counting(frame, path, **options):
        tasks.append(frame.rdd.getNumPartitions())
        export(frame, path, **options)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(single_file, "export_csv", counting)
        export_csv_file(df, str(tmp_path / "loads.csv"))
    assert tasks == [1, 7]  # the header, the rows


def test_modes_and_empty(spark, tmp_path):
    path = str(tmp_path / "a b" / "loads.csv")
    export_csv_file(many_parts(spark).limit(0), path)
    assert Path(path).read_text() == "id,text,share\n"
    with pytest.raises(FileExistsError):
        export_csv_file(many_parts(spark), path)
    export_csv_file(many_parts(spark, 3), path, mode="overwrite")
    assert Path(path).read_text().count("\n") == 4
    export_csv_file(many_parts(spark).limit(0), path, header=False, mode="overwrite")
    assert Path(path).read_bytes() == b""
    with pytest.raises(ValueError):
        export_csv_file(many_parts(spark), path, mode="append")


def test_old_file_stays_when_the_write_fails(spark, tmp_path):
    path = tmp_path / "loads.csv"
    path.write_text("old\n")
    broken = many_parts(spark).select(F.when(F.col("id") > 1500, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        export_csv_file(broken, str(path), mode="overwrite")
    assert path.read_text() == "old\n" and [p.name for p in tmp_path.iterdir()] == ["loads.csv"]


class _WithConcat(single_file._Files):
    """The local file system, taken for one whose concat call appends: what Hadoop's contract says."""

    def __init__(self, spark, folder):
        super().__init__(spark, folder)
        self.concat, real = True, self.system

        class System:
            def __getattr__(self, name):
                return getattr(real, name)

            def concat(self, target, others):
                target = Path(target.toUri().getPath())
                assert target.exists() and all(Path(o.toUri().getPath()).parent == target.parent for o in others)
                with open(target, "ab") as sink:
                    for other in others:
                        sink.write(Path(other.toUri().getPath()).read_bytes())
                target.with_name(f".{target.name}.crc").unlink(missing_ok=True)

        self.system = System()


def test_concat_of_the_file_system(spark, tmp_path, monkeypatch):
    df = many_parts(spark)
    monkeypatch.setattr(single_file, "_Files", _WithConcat)
    export_csv_file(df, str(tmp_path / "out" / "loads.csv"))
    assert (tmp_path / "out" / "loads.csv").read_bytes() == plain_bytes(df, tmp_path / "plain")


def test_other_stores_refuse(spark, tmp_path, monkeypatch):
    class Store(single_file._Files):
        def __init__(self, spark, folder):
            super().__init__(spark, folder)
            self.joins = False

    monkeypatch.setattr(single_file, "_Files", Store)
    with pytest.raises(CannotJoinFiles):
        export_csv_file(many_parts(spark), str(tmp_path / "loads.csv"))
    assert list(tmp_path.iterdir()) == []


def test_hand_over_one_file(spark, tmp_path):
    df = many_parts(spark)
    export_csv_file(df, str(tmp_path / "drops" / "d2" / "loads.csv"))
    out = tmp_path / "out" / "sent.csv"
    sent = hand_over_latest_drop(spark, str(tmp_path / "drops"), str(out), whole_drop=False, single_file=True)
    assert out.is_file() and rows_of(sent) == rows_of(read_text_csv(spark, str(tmp_path / "drops" / "d2")))
    assert read_latest_csv(spark, str(tmp_path / "drops"), df.schema).count() == 2000
