"""Song popularity: per-song features -> RSI -> ranks (the DM song marts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.functions.scoring import with_rsi
from playmart.operators.features import WINDOW_LABELS, feature_names
from playmart.operators.ranking import rank_rows, unpivot

RSI_PERIODS = {"1": "RSI_1", "7": "RSI_7", "30": "RSI_30"}


def feature_columns() -> list[str]:
    cols = []
    for w in (0, 7, 30):
        cols += list(feature_names(WINDOW_LABELS[w]))
    return cols + ["top7day", "top30day"]


def rank_by_period(
    df: DataFrame,
    id_cols: list[str],
    tie_break: list[str],
    day_col: str | None = "dt_data",
    descending: bool = False,
    num_ranges: int | None = None,
) -> DataFrame:
    """Unpivot RSI_1/7/30 into (period, RSI) and number rows per period (and
    day) ascending with NULLs first: one pass instead of three window queries
    and a union. ``tie_break`` must identify a row within a period and day."""
    keep = ([day_col] if day_col else []) + id_cols
    long = unpivot(df, keep, RSI_PERIODS, "period", "RSI")
    part = ([day_col] if day_col else []) + ["period"]
    return rank_rows(long, ["RSI"], part, tie_break, out="RSI_RANK", descending=descending, num_ranges=num_ranges)


def song_rank(features: DataFrame, descending: bool = False) -> DataFrame:
    """tm_song_rsi: period, songid, songname, singer1, singer2, RSI, RSI_RANK (+ dt_data)."""
    ids = ["songid", "songname", "singer1", "singer2"]
    # A song whose attributes vary has several rows with one RSI: all id columns break the tie.
    ranked = rank_by_period(with_rsi(features), ids, ids, descending=descending)
    return ranked.select("period", "songid", "songname", "singer1", "singer2", "RSI", "RSI_RANK", "dt_data")


def singer_features(features: DataFrame, singer: str = "singer1") -> DataFrame:
    """Per-singer sums of the 14 song features (distinct counts are summed)."""
    return features.groupBy(singer).agg(*[F.sum(c).alias(c) for c in feature_columns()])


def singer_rank(features: DataFrame, singer: str = "singer1", descending: bool = False) -> DataFrame:
    """tm_singer_rsi: global rank per period (no day partition in the original)."""
    scored = with_rsi(singer_features(features, singer))
    return rank_by_period(scored, [singer], [singer], day_col=None, descending=descending).select(
        "period", singer, "RSI", "RSI_RANK"
    )
