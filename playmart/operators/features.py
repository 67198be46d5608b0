"""Per-key activity features over trailing day windows.

``rolling_features`` computes the 1/7/30-day play counts, distinct users,
distinct orders and the peak day of every key in ONE scan of the day range:
each row is tagged three ways (day, user, order), pre-aggregated map-side to
one row per (key, tag, value) holding its last active day, then folded per key
with conditional counts. A user counts in window w iff its last active day is
inside w, so every distinct count is exact without one Expand per window.
Hot keys are harmless: the first shuffle is keyed by (key, tag, value) and the
second only carries one partial row per key and map task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions.dates import shift_day

# The reference feature-table column names per window.
WINDOW_LABELS = {0: "", 7: "Seven", 30: "Thirty"}


def feature_names(label: str) -> tuple[str, str, str, str]:
    """(plays, supplement, distinct users, distinct orders) column names."""
    return (
        f"per{label}SongNBM",
        f"per{label}SongSuppNBM",
        f"per{label}UserSongNBM",
        f"per{label}OrderSongNBM",
    )


def _day_filter(dt: str, start: str, end: str) -> Column:
    # String comparison on equal-width yyyyMMdd keys: prunes day partitions.
    return F.col(dt).between(F.lit(start), F.lit(end))


def rolling_features(
    df: DataFrame,
    run_date: str,
    key: str = "songid",
    dt: str = "dt_data",
    user: str = "uid",
    order: str = "order_id",
    windows: tuple[int, ...] = (0, 7, 30),
    peaks: tuple[int, ...] = (7, 30),
    labels: dict[int, str] | None = None,
) -> DataFrame:
    """One row per key active in the widest window.

    ``windows`` are days back from ``run_date`` (inclusive range, so 7 -> 8
    days). Columns of a window the key was not active in are NULL; peak
    columns ``top{w}day`` are the largest daily play count inside window w
    (0 when active in the widest window only).
    """
    widest = max(windows + peaks)
    start = shift_day(run_date, widest)
    per_value = value_rows(df.where(_day_filter(dt, start, run_date)), key, dt, user, order).groupBy("_k", "kind", "grp").agg(
        # The last day is kept as an int (yyyyMMdd keys compare like their ints):
        # fixed-width buffers keep the aggregation hash-based, not sort-based.
        F.count("_k").alias("n"), F.max(F.col("_dt").cast("int")).alias("last_dt")
    )
    return fold_values(per_value, lambda w: F.col("last_dt") >= F.lit(int(shift_day(run_date, w))), key, windows, peaks, labels)


def value_rows(df: DataFrame, key: str, dt: str, user: str, order: str) -> DataFrame:
    """Each row three times, as (_k, _dt, kind, grp): its day (kind 0), its user (1), its order (2; no NULL users and orders)."""
    base = df.select(F.col(key).alias("_k"), F.col(dt).alias("_dt"), F.col(user).alias("_u"), F.col(order).alias("_o"))
    kinds = [F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("grp")) for k, c in enumerate(("_dt", "_u", "_o"))]
    return base.select("_k", "_dt", F.inline(F.array(*kinds))).where((F.col("kind") == 0) | F.col("grp").isNotNull())


def fold_values(
    per_value: DataFrame,
    seen: Callable[[int], Column],
    key: str,
    windows: tuple[int, ...],
    peaks: tuple[int, ...],
    labels: dict[int, str] | None = None,
) -> DataFrame:
    """(_k, kind, grp, n) rows -> one row per key. ``seen(w)``: was the value active in window w."""
    labels = {**WINDOW_LABELS, **(labels or {})}
    aggs = []
    for w in sorted(set(windows) | set(peaks)):
        day_in = (F.col("kind") == 0) & seen(w)
        aggs += [
            F.max(F.when(day_in, F.lit(True))).alias(f"_act{w}"),
            F.sum(F.when(day_in, F.col("n"))).alias(f"_plays{w}"),
            F.max(F.when(day_in, F.col("n"))).alias(f"_peak{w}"),
            F.count_if((F.col("kind") == 1) & seen(w)).alias(f"_users{w}"),
            F.count_if((F.col("kind") == 2) & seen(w)).alias(f"_orders{w}"),
        ]
    folded = per_value.groupBy("_k").agg(*aggs)

    out = [F.col("_k").alias(key)]
    for w in windows:
        plays, supp, users, orders = feature_names(labels[w])
        act = F.coalesce(F.col(f"_act{w}"), F.lit(False))
        out += [
            F.when(act, F.col(f"_plays{w}")).alias(plays),
            F.when(act, F.lit(0)).alias(supp),
            F.when(act, F.col(f"_users{w}")).alias(users),
            F.when(act, F.col(f"_orders{w}")).alias(orders),
        ]
    for w in peaks:
        out.append(F.coalesce(F.col(f"_peak{w}"), F.lit(0).cast("long")).alias(f"top{w}day"))
    return folded.select(*out)


def window_counts(
    df: DataFrame,
    run_date: str,
    days: int,
    key: str = "songid",
    dt: str = "dt_data",
    user: str = "uid",
    order: str = "order_id",
    label: str | None = None,
) -> DataFrame:
    """Per-key counts over ``[run_date - days, run_date]``: plays, constant 0
    supplement, distinct users, distinct orders. Only keys active in the range.
    """
    label = WINDOW_LABELS.get(days, str(days)) if label is None else label
    plays, supp, users, orders = feature_names(label)
    feats = rolling_features(df, run_date, key, dt, user, order, windows=(days,), peaks=(), labels={days: label})
    return feats.where(F.col(plays).isNotNull())


def daily_counts(df: DataFrame, start: str, end: str, key: str = "songid", dt: str = "dt_data") -> DataFrame:
    """Rows per (day, key) inside ``[start, end]`` (count of non-NULL keys)."""
    return df.where(_day_filter(dt, start, end)).groupBy(dt, key).agg(F.count(key).alias("cnt"))


def peak_days(
    df: DataFrame,
    run_date: str,
    key: str = "songid",
    dt: str = "dt_data",
    windows: tuple[int, ...] = (7, 30),
    per_key: bool = True,
) -> DataFrame:
    """Largest daily play count inside each trailing window.

    ``per_key=True`` gives one row per key active in the widest window.
    ``per_key=False`` reproduces the un-grouped original: one global row whose
    key is the smallest active key (a legal pick of the arbitrary original).
    """
    widest = max(windows)
    daily = daily_counts(df, shift_day(run_date, widest), run_date, key, dt)
    peaks = [
        F.max(
            F.when(F.col(dt) >= F.lit(shift_day(run_date, w)), F.col("cnt")).otherwise(F.lit(0).cast("long"))
        ).alias(f"top{w}day")
        for w in windows
    ]
    if per_key:
        return daily.where(F.col(key).isNotNull()).groupBy(key).agg(*peaks)
    return daily.agg(F.min(key).alias(key), *peaks)


def feature_wide(history: DataFrame, features: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Every distinct (key, attributes) of the history with its features.

    Equals ``SELECT DISTINCT h.key, h.attrs..., f.* FROM history h LEFT JOIN
    features f`` because features hold one row per key; duplicates go before the join.
    """
    return history.select(key, *attrs).distinct().join(features, on=key, how="left")
