"""Trailing-window features from a maintained state instead of a scan of the whole window.

The state has one row per (key, kind, value), as in ``rolling_features``: kind 0 is a day with
its play count, 1 a user, 2 an order. Its ``days`` is a bit mask, bit i for activity i days
before the state's day. To advance is to shift the masks and merge in the new day's rows, so a day costs
the state plus that day, whatever the widest window. A window of w days is the lowest w + 1 bits.

As the masks tell the days apart, a day can be read again: a late or re-sent day first loses its
bit everywhere and then gets it from the rows as they are now. Values without a bit left go.

States are partitions of one table, ``as_of=yyyyMMdd``; advancing to a day reads the latest
state before it, so a re-run gives the same partition. The widest window is at most 62 days;
keys are kept as text.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.functions.dates import shift_day
from playmart.operators.features import fold_values, value_rows

MAX_DAYS_BACK = 62
AS_OF = "as_of"
STATE = "_k string, kind int, grp string, n long, days long"


def _gap(earlier: str, later: str) -> int:
    day = lambda s: datetime.datetime.strptime(s, "%Y%m%d")
    return (day(later) - day(earlier)).days


def days_between(after: str, last: str) -> list[str]:
    """The days after ``after`` up to ``last``."""
    return [shift_day(last, i) for i in range(_gap(after, last))]


def day_state(
    plays: DataFrame, as_of: str, days: list[str], key: str = "songid", dt: str = "dt_data", user: str = "uid", order: str = "order_id"
) -> DataFrame:
    """State rows of the plays of ``days``; only these day partitions are read."""
    back = {d: _gap(d, as_of) for d in days}
    bit = F.lit(0).cast("long")
    for d, i in back.items():
        bit = F.when(F.col("_dt") == F.lit(d), F.lit(1 << i).cast("long")).otherwise(bit)
    rows = value_rows(plays.where(F.col(dt).isin(days)), key, dt, user, order)
    return rows.groupBy(F.col("_k").cast("string").alias("_k"), "kind", "grp").agg(F.count("_k").alias("n"), F.bit_or(bit).alias("days"))


def advance(state: DataFrame | None, state_day: str | None, rows: DataFrame, as_of: str, days: list[str], widest: int = 30) -> DataFrame:
    """The state of ``as_of``: ``state`` (of ``state_day``) with ``days`` replaced by ``rows`` (``day_state``).

    ``days`` must hold every day after ``state_day``, and any earlier day that changed.
    """
    if widest > MAX_DAYS_BACK:
        raise ValueError(f"the widest window is at most {MAX_DAYS_BACK} days back")
    window = (1 << (widest + 1)) - 1
    merged = rows
    if state is not None:
        gap = _gap(state_day, as_of)
        if gap < 0:
            raise ValueError(f"the state of {state_day} is later than {as_of}")
        missing = sorted(set(days_between(state_day, as_of)) - set(days))
        if missing:
            raise ValueError(f"days {missing} after {state_day} are not read")
        kept = window
        for d in days:
            if 0 <= _gap(d, as_of) <= widest:
                kept &= ~(1 << _gap(d, as_of))
        moved = F.shiftleft("days", gap) if gap <= MAX_DAYS_BACK else F.lit(0).cast("long")
        old = state.select("_k", "kind", "grp", "n", moved.bitwiseAND(F.lit(kept).cast("long")).alias("days")).where("days != 0")
        merged = old.unionByName(rows)
    out = merged.groupBy("_k", "kind", "grp").agg(F.sum("n").alias("n"), F.bit_or("days").alias("days"))
    # Of a user or order only the days count; of a day, the plays.
    n = F.when(F.col("kind") == 0, F.col("n")).otherwise(F.lit(0).cast("long"))
    out = out.select("_k", "kind", "grp", n.alias("n"), F.col("days").bitwiseAND(F.lit(window).cast("long")).alias("days"))
    return out.where("days != 0")


def features_of_state(
    state: DataFrame,
    key: str = "songid",
    windows: tuple[int, ...] = (0, 7, 30),
    peaks: tuple[int, ...] = (7, 30),
    labels: dict[int, str] | None = None,
) -> DataFrame:
    """The columns of ``rolling_features`` for the state's day."""
    seen = lambda w: F.col("days").bitwiseAND(F.lit((1 << (w + 1)) - 1).cast("long")) != 0
    return fold_values(state, seen, key, windows, peaks, labels)


class FeatureState:
    """The stored states of one table of plays."""

    def __init__(self, spark: SparkSession, path: str, widest: int = 30):
        self.spark, self.path, self.widest = spark, path, widest

    def read(self) -> DataFrame | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return None
        return self.spark.read.schema(f"{STATE}, {AS_OF} string").parquet(self.path)

    def latest(self, before: str | None = None) -> str | None:
        """The day of the latest state (before a day); only partition names are read."""
        states = self.read()
        if states is None:
            return None
        days = states.select(AS_OF).distinct()
        return (days if before is None else days.where(F.col(AS_OF) < F.lit(before))).agg(F.max(AS_OF)).first()[0]

    def of(self, day: str) -> DataFrame:
        return self.read().where(F.col(AS_OF) == F.lit(day)).drop(AS_OF)

    def advance(self, plays: DataFrame, as_of: str, changed: list[str] | tuple = (), **columns: str) -> DataFrame:
        """Store and return the state of ``as_of``: the days since the latest state before it, and the
        ``changed`` earlier ones, are read from ``plays``. Without a state the whole window is read."""
        last = self.latest(before=as_of)
        new = days_between(last, as_of) if last else days_between(shift_day(as_of, self.widest + 1), as_of)
        oldest = shift_day(as_of, self.widest)
        days = sorted({d for d in [*new, *changed] if oldest <= d <= as_of})
        if last and last < oldest:
            last = None
        rows = day_state(plays, as_of, days, **columns)
        state = advance(self.of(last) if last else None, last, rows, as_of, days, self.widest)
        out = state.withColumn(AS_OF, F.lit(as_of)).hint("rebalance")
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(AS_OF).parquet(self.path)
        return self.of(as_of)
