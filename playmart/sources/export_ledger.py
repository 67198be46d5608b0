"""Exports that can be run again: a manifest says what the result store already holds.

The manifest is a table of (table, day, rows, checksum, state, seq). A run compares the checksum of
each day of the source with the last one recorded and sends only days that are new or changed; a
changed day replaces what was sent before. The checksum is a sum over hashes of whole rows, so it
doesn't depend on their order and is one aggregation over the source.

A day is recorded as ``sending`` before and as ``done`` after it is written. A day that a failed run left
as ``sending`` counts as changed, so it is replaced and not added twice.

Files are partitioned by day and a day is replaced by Spark's dynamic partition overwrite. A JDBC
table can't delete through Spark's writer: the caller passes ``delete_day``, which removes
one day's rows; without it a changed day is an error instead of a duplicate. A table without days
is one unit, overwritten when it changes.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.sources.tables import DAY_COL, write_days

MANIFEST = "target string, day string, n long, checksum string, state string, seq long"
SENDING, DONE = "sending", "done"
WHOLE = ""  # the day of a table without days


def checksums(df: DataFrame, day_col: str = DAY_COL) -> DataFrame:
    """(day, n, checksum) of every day of ``df``, or of the whole table."""
    day = F.col(day_col).cast("string") if day_col in df.columns else F.lit(WHOLE)
    # Columns in the order of their names; a NULL is told from the value next to it.
    cols = [c for c in sorted(df.columns) if c != day_col]
    parts: list[Column] = [p for c in cols for p in (F.col(c).isNull(), F.col(c))]
    row = F.xxhash64(*parts).cast("decimal(38,0)")
    return df.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum(row).cast("string").alias("checksum"))


class ExportLedger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def recorded(self, target: str) -> dict[str, tuple]:
        """day -> (n, checksum, state) as last recorded; bounded by the days of one table."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return {}
        rows = self.spark.read.schema(MANIFEST).parquet(self.path).where(F.col("target") == F.lit(target))
        last = rows.groupBy("day").agg(F.max_by(F.struct("n", "checksum", "state"), "seq").alias("x"))
        return {r["day"]: tuple(r["x"]) for r in last.collect()}

    def record(self, target: str, days: dict[str, tuple], state: str) -> None:
        seq = time.time_ns()
        rows = [(target, day, n, checksum, state, seq) for day, (n, checksum) in sorted(days.items())]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(self.path)

    def changes(self, df: DataFrame, target: str, day_col: str = DAY_COL) -> tuple[dict, set]:
        """The days to send with (n, checksum), and which of them were sent before."""
        before = self.recorded(target)
        send = {r["day"]: (r["n"], r["checksum"]) for r in checksums(df, day_col).collect()}
        send = {d: x for d, x in send.items() if before.get(d) != (*x, DONE)}
        return send, {d for d in send if d in before}

    def export(
        self,
        df: DataFrame,
        target: str,
        fmt: str = "parquet",
        path: str | None = None,
        options: dict | None = None,
        day_col: str = DAY_COL,
        delete_day: Callable[[str], None] | None = None,
    ) -> list[str]:
        """Bring the store's ``target`` up to ``df``; returns the days that were sent."""
        send, again = self.changes(df, target, day_col)
        if not send:
            return []
        whole = day_col not in df.columns
        if again and path is None and not whole and delete_day is None:
            raise ValueError(f"days {sorted(again)} of {target} changed: pass delete_day to replace them")
        self.record(target, send, SENDING)
        rows = df if whole else df.where(F.col(day_col).isin(list(send)))
        if path is not None and not whole:
            write_days(rows, path, fmt=fmt)
        else:
            for day in sorted(again) if not whole else ():
                delete_day(day)
            writer = rows.write.format(fmt).mode("overwrite" if whole else "append").options(**(options or {}))
            writer.save(path) if path is not None else writer.save()
        self.record(target, send, DONE)
        return sorted(send)
