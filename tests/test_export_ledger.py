"""What a run of an export sends, and what a failed one leaves."""

import pytest
from pyspark.sql import functions as F

from playmart.sources.export_ledger import SENDING, ExportLedger, checksums

DDL = "k int, v string, dt_data string"


def rows_of(spark, path):
    return sorted(tuple(r) for r in spark.read.schema(DDL).parquet(path).collect())


def test_only_new_and_changed_days_are_sent(spark, tmpdir_path):
    ledger, out = ExportLedger(spark, f"{tmpdir_path}/manifest"), f"{tmpdir_path}/out"
    rows = [(1, "a", "d1"), (2, None, "d1"), (3, "c", "d2")]
    send = lambda rows: ledger.export(spark.createDataFrame(rows, DDL), "t", path=out)
    assert send(rows) == ["d1", "d2"] and send(rows) == [] and send(rows[::-1]) == []
    assert rows_of(spark, out) == sorted(rows, key=str) or len(rows_of(spark, out)) == 3
    rows += [(4, "d", "d3")]
    rows[0] = (9, "a", "d1")
    assert send(rows) == ["d1", "d3"]
    assert sorted(map(str, rows_of(spark, out))) == sorted(map(str, rows))
    other = ledger.export(spark.createDataFrame(rows, DDL), "another", path=f"{tmpdir_path}/other")
    assert other == ["d1", "d2", "d3"]


def test_a_failed_run_is_replaced(spark, tmpdir_path):
    ledger, out = ExportLedger(spark, f"{tmpdir_path}/manifest"), f"{tmpdir_path}/out"
    df = spark.createDataFrame([(1, "a", "d1"), (2, "b", "d2")], DDL)
    ledger.record("t", {"d1": (1, "half written")}, SENDING)
    df.where("dt_data = 'd1'").write.partitionBy("dt_data").parquet(out)
    assert ledger.export(df, "t", path=out) == ["d1", "d2"] and len(rows_of(spark, out)) == 2
    ledger.record("t", {r["day"]: (r["n"], r["checksum"]) for r in checksums(df).collect() if r["day"] == "d2"}, SENDING)
    assert ledger.export(df, "t", path=out) == ["d2"] and len(rows_of(spark, out)) == 2


def test_store_without_partitions_needs_a_delete(spark, tmpdir_path):
    """As a JDBC table: rows are appended, and a changed day is removed first."""
    ledger, out = ExportLedger(spark, f"{tmpdir_path}/manifest"), f"{tmpdir_path}/out"
    store = lambda rows, **more: ledger.export(spark.createDataFrame(rows, DDL), "t", options={"path": out}, **more)
    store([(1, "a", "d1")])
    with pytest.raises(ValueError):
        store([(1, "b", "d1")])
    deleted = []
    assert store([(1, "b", "d1"), (2, "c", "d2")], delete_day=deleted.append) == ["d1", "d2"] and deleted == ["d1"]


def test_checksums(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, "1", "x"), (1, None, "y")], DDL)
    got = {r["day"]: r["checksum"] for r in checksums(df).collect()}
    assert got["x"] != got["y"]
    swapped = spark.createDataFrame([(None, "a", "x")], DDL), spark.createDataFrame([(0, "a", "x")], DDL)
    assert checksums(swapped[0]).first()["checksum"] != checksums(swapped[1]).first()["checksum"]
    whole = df.drop("dt_data")
    assert checksums(whole).first()["day"] == "" and checksums(whole).first()["n"] == 3
    assert checksums(df.where(F.lit(False))).count() == 0


def test_table_without_days_is_overwritten_when_it_changes(spark, tmpdir_path):
    ledger, out = ExportLedger(spark, f"{tmpdir_path}/manifest"), f"{tmpdir_path}/out"
    for rows, sent in (([(1, "a")], [""]), ([(1, "a")], []), ([(1, "a"), (2, "b")], [""])):
        assert ledger.export(spark.createDataFrame(rows, "k int, v string"), "t", path=out) == sent
        assert spark.read.parquet(out).count() == len(rows)
