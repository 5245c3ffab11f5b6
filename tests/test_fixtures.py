"""The prepared tables follow their input and survive the loss of the scratch folder."""

from pathlib import Path

from pyspark.sql import functions as F

from freight.plans import hand_over_latest_drop
from freight.sinks import export_csv
from workload import fixtures

SF = "/root/testdata/sf0.001"


def test_prepared_tables_are_written_once_and_again_when_needed(spark, tmp_path, monkeypatch):
    tables = str(tmp_path / "tables")
    for name in ["orders", "lineitem", "customer", "supplier", "part", "nation", "region"]:
        fixtures.table(spark, SF, name).write.parquet(f"{tables}/{name}.parquet")
    first = fixtures.staged_folder(spark, tables)
    assert fixtures.staged_folder(spark, tables) == first
    assert fixtures.staged(spark, tables).count() == 1500

    # as if the scratch folder had been emptied meanwhile
    for state, folder in list(fixtures._written.items()):
        if folder == first:
            monkeypatch.setitem(fixtures._written, state, str(tmp_path / "gone"))
    second = fixtures.staged_folder(spark, tables)
    assert second != first and fixtures.staged(spark, tables).count() == 1500

    extra = fixtures.table(spark, SF, "orders").withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000)
    extra.write.mode("append").parquet(f"{tables}/orders.parquet")
    assert fixtures.staged(spark, tables).count() == 3000


def test_drops_are_packed_and_read_back_whole(spark, tmp_path):
    raw = Path(fixtures.raw_drop(spark, SF))
    parts = [p.name for p in raw.iterdir() if p.name.startswith("part-")]
    assert parts and all(name.endswith(".csv.gz") for name in parts)
    assert fixtures.loads_raw(spark, SF).exceptAll(fixtures.loads_from_tables(spark, SF)).isEmpty()
    rows = [(1, "a,b"), (2, None), (3, " x ")]
    export_csv(spark.createDataFrame(rows, "id long, t string"), str(tmp_path / "drops" / "d1"), compression="gzip")
    sent = hand_over_latest_drop(spark, str(tmp_path / "drops"), str(tmp_path / "out"), compression="gzip")
    assert sorted((int(r.id), r.t) for r in sent.collect()) == rows
    assert all(p.name.endswith(".gz") for p in (tmp_path / "out").iterdir() if p.name.startswith("part-"))
