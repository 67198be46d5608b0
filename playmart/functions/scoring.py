"""Popularity index (RSI) and revenue-share expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the popularity index.
PLAY_WEIGHT = 0.63
PLAY_SHARE = 0.8
SUPP_SHARE = 0.2
PEAK_WEIGHT = 0.37
DAY_SCALE = 10
WEEK_DIVISOR = 7  # the 30-day index also divides by 7


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rsi_1(plays, supp) -> Column:
    """``(ln(n/1+1)*0.63*0.8 + ln(s/1+1)*0.63*0.2)^2 * 10``."""
    n, s = _col(plays), _col(supp)
    inner = (
        F.log(n / 1 + 1) * PLAY_WEIGHT * PLAY_SHARE
        + F.log(s / 1 + 1) * PLAY_WEIGHT * SUPP_SHARE
    )
    return F.pow(inner, 2) * DAY_SCALE


def rsi_n(plays, supp, peak, divisor: int = WEEK_DIVISOR) -> Column:
    """``((ln(n/7+1)*0.63*0.8 + ln(s/7+1)*0.2) + ln(t/7+1)*0.37*0.8)^2``.

    The supplement term has no 0.63 weight; the 30-day index uses the same
    divisor 7. Operand order is kept because float results depend on it.
    """
    n, s, t = _col(plays), _col(supp), _col(peak)
    inner = (
        F.log(n / divisor + 1) * PLAY_WEIGHT * PLAY_SHARE
        + F.log(s / divisor + 1) * SUPP_SHARE
    ) + F.log(t / divisor + 1) * PEAK_WEIGHT * PLAY_SHARE
    return F.pow(inner, 2)


def with_rsi(df, cols: dict | None = None):
    """Add RSI_1 / RSI_7 / RSI_30 from the feature columns of ``song_features``."""
    c = {
        "n1": "perSongNBM", "s1": "perSongSuppNBM",
        "n7": "perSevenSongNBM", "s7": "perSevenSongSuppNBM", "t7": "top7day",
        "n30": "perThirtySongNBM", "s30": "perThirtySongSuppNBM", "t30": "top30day",
    }
    c.update(cols or {})
    return (
        df.withColumn("RSI_1", rsi_1(c["n1"], c["s1"]))
        .withColumn("RSI_7", rsi_n(c["n7"], c["s7"], c["t7"]))
        .withColumn("RSI_30", rsi_n(c["n30"], c["s30"], c["t30"]))
    )


def share(revenue, refund, rate, precision: int = 20, scale: int = 2) -> Column:
    """``cast(revenue*rate - refund*rate as decimal(p,s))``."""
    r = _col(rate)
    return (_col(revenue) * r - _col(refund) * r).cast(f"decimal({precision},{scale})")
