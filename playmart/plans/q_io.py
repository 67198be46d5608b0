"""Registered storage round trips: day-partition overwrite, append and export.

Each call writes under a fresh folder inside the shared checkpoint folder
(``spark.checkpoint.dir``) and returns what was read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from playmart.functions.dates import shift_day
from playmart.plans import schemas as S
from playmart.plans.driver_tables import RUN_DATE, table
from playmart.session import scratch_path
from playmart.sources import logs
from playmart.sources.export_ledger import ExportLedger
from playmart.sources.sinks import export
from playmart.sources.tables import (
    DAY_COL, append_day, overwrite_table, read_day_table, read_text_table, write_day, write_days, write_text_table,
)


def play_rows(spark, d):
    """events as ODS play-log rows (all 11 text fields + day)."""
    e = table(spark, d, "events")
    return e.select(
        F.get_json_object("props", "$.k").alias("songid"),
        (F.col("event_id") % 100).cast("string").alias("mid"),
        F.col("event_type").alias("optrate_type"),
        F.col("user_id").cast("string").alias("uid"),
        F.lit(None).cast("string").alias("consume_type"),
        F.date_format("ts", "yyyyMMddHHmmss").alias("play_time"),
        F.col("value").cast("string").alias("dur_time"),
        F.lit(None).cast("string").alias("session_id"),
        F.lit(None).cast("string").alias("songname"),
        F.lit(None).cast("string").alias("pkg_id"),
        F.col("event_id").cast("string").alias("order_id"),
        F.date_format("ts", "yyyyMMdd").alias(DAY_COL),
    )


ROWS = ("songid", "mid", "optrate_type", "uid", "play_time", "order_id", DAY_COL)


def q_day_overwrite_roundtrip(spark, d):
    """Write every day, then overwrite the run day twice: the run day's rows are
    there once and all other days are untouched."""
    path = scratch_path(spark, f"roundtrip-{uuid.uuid4().hex}")
    rows = play_rows(spark, d)
    write_days(rows, path)
    one_day = rows.where(F.col(DAY_COL) == F.lit(RUN_DATE))
    write_day(one_day, path, RUN_DATE)
    write_day(one_day, path, RUN_DATE)
    return read_day_table(spark, path, S.PLAY_LOG).select(*ROWS)


def q_append_export_roundtrip(spark, d):
    """Append the run day once more (insert-into semantics: doubled), export all
    partitions with append, then read the export back."""
    base = scratch_path(spark, f"append-{uuid.uuid4().hex}")
    rows = play_rows(spark, d)
    write_days(rows, f"{base}/table")
    append_day(rows.where(F.col(DAY_COL) == F.lit(RUN_DATE)), f"{base}/table", RUN_DATE)
    stored = read_day_table(spark, f"{base}/table", S.PLAY_LOG)
    export(stored, f"{base}/export", fmt="parquet", mode="append")
    return spark.read.schema(stored.schema).parquet(f"{base}/export").select(*ROWS)


def q_export_ledger_roundtrip(spark, d):
    """Three runs of one export, an old day changed between them; the store holds each day once, as it is now."""
    base = scratch_path(spark, f"ledger-{uuid.uuid4().hex}")
    ledger = ExportLedger(spark, f"{base}/manifest")
    rows, old = play_rows(spark, d), shift_day(RUN_DATE, 9)
    write_days(rows.where(F.col(DAY_COL) != F.lit(RUN_DATE)), f"{base}/table")
    write_day(rows.where((F.col(DAY_COL) == F.lit(old)) & (F.col("mid") < "5")), f"{base}/table", old)  # half of its rows came late
    for late in (None, RUN_DATE, old):
        if late:
            write_day(rows.where(F.col(DAY_COL) == F.lit(late)), f"{base}/table", late)
        ledger.export(read_day_table(spark, f"{base}/table", S.PLAY_LOG), "plays", path=f"{base}/export")
    return read_day_table(spark, f"{base}/export", S.PLAY_LOG).select(*ROWS)


def q_snapshot_overwrite_roundtrip(spark, d):
    """S8 + S11: an un-partitioned table overwritten by other rows, exported in
    overwrite mode with a constant day."""
    base = scratch_path(spark, f"snapshot-{uuid.uuid4().hex}")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    overwrite_table(c.where("c_nationkey < 5"), f"{base}/table")
    overwrite_table(c, f"{base}/table")
    for _ in range(2):
        export(spark.read.parquet(f"{base}/table"), f"{base}/export", mode="overwrite", constant_day=RUN_DATE)
    return spark.read.schema(f"c_custkey long, c_name string, c_nationkey int, {DAY_COL} string").parquet(f"{base}/export")


def q_text_table_roundtrip(spark, d):
    """A tab-separated table with an array column, written and read with its types."""
    path = scratch_path(spark, f"text-{uuid.uuid4().hex}")
    p = table(spark, d, "part")
    sizes = F.when(F.col("p_size") % 5 == 0, F.array().cast("array<int>")).otherwise(
        F.array(F.col("p_size"), F.col("p_size") + 1).cast("array<int>")
    )
    rows = p.select("p_partkey", "p_name", sizes.alias("sizes"), F.when(F.col("p_size") % 3 != 0, F.col("p_brand")).alias("brand"))
    write_text_table(rows, path)
    return read_text_table(spark, path, rows.schema)


def q_routed_roundtrip(spark, d):
    """One output folder per event type; the key is the folder, not a field of the records."""
    path = scratch_path(spark, f"routed-{uuid.uuid4().hex}")
    e = table(spark, d, "events")
    logs.write_routed(e.select("event_type", F.concat_ws("|", "event_id", "user_id").alias("record")), path)
    return spark.read.schema("value string, event_type string").text(path).select("event_type", F.col("value").alias("record"))


QUERIES = {
    "day_overwrite_roundtrip": q_day_overwrite_roundtrip,
    "append_export_roundtrip": q_append_export_roundtrip,
    "export_ledger_roundtrip": q_export_ledger_roundtrip,
    "snapshot_overwrite_roundtrip": q_snapshot_overwrite_roundtrip,
    "text_table_roundtrip": q_text_table_roundtrip,
    "routed_roundtrip": q_routed_roundtrip,
}

_PLAYS = """SELECT json_extract_string(props, '$.k') AS songid, CAST(event_id % 100 AS VARCHAR) AS mid,
       event_type AS optrate_type, CAST(user_id AS VARCHAR) AS uid, strftime(ts, '%Y%m%d%H%M%S') AS play_time,
       CAST(event_id AS VARCHAR) AS order_id, strftime(ts, '%Y%m%d') AS dt_data
FROM events"""

ORACLE = {
    "day_overwrite_roundtrip": _PLAYS,
    "export_ledger_roundtrip": _PLAYS,
    "append_export_roundtrip": f"{_PLAYS} UNION ALL SELECT * FROM ({_PLAYS}) WHERE dt_data = '{RUN_DATE}'",
    "snapshot_overwrite_roundtrip": f"SELECT c_custkey, c_name, c_nationkey, '{RUN_DATE}' AS dt_data FROM customer",
    "text_table_roundtrip": """SELECT p_partkey, p_name,
       CASE WHEN p_size % 5 = 0 THEN CAST([] AS INTEGER[]) ELSE [CAST(p_size AS INTEGER), CAST(p_size + 1 AS INTEGER)] END AS sizes,
       CASE WHEN p_size % 3 <> 0 THEN p_brand END AS brand
FROM part""",
    "routed_roundtrip": """SELECT event_type, CAST(event_id AS VARCHAR) || '|' || CAST(user_id AS VARCHAR) AS record
FROM events""",
}
