"""Registered song queries on the driver tables (features, peaks, RSI, ranks).

Each query has a DuckDB oracle written independently in plain SQL, following
the original three-scan / left-join formulation rather than our one-pass plan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from playmart.functions.dates import shift_day
from playmart.functions.scoring import with_rsi
from playmart.operators import features as feat
from playmart.operators.feature_state import FeatureState, features_of_state
from playmart.operators.ranking import rank_rows
from playmart.operators.songs import rank_by_period, singer_features
from playmart.plans.driver_tables import RUN_DATE, play_log, song_plays, table
from playmart.session import scratch_path

D0 = RUN_DATE
D7 = shift_day(RUN_DATE, 7)
D30 = shift_day(RUN_DATE, 30)
R6 = 6  # decimals kept for float outputs compared across engines


def q_song_play_join(spark, d):
    """J1 + P5: one day of plays joined to the catalogue on songid = source_id."""
    plays = song_plays(spark, d, D0, D0).where(F.col("dt_data") == F.lit(D0))
    return plays.select("songid", "songname", "singer1", "uid", "order_id", "dt_data")


def _features_window(days):
    def q(spark, d):
        return feat.window_counts(play_log(spark, d, shift_day(RUN_DATE, days), RUN_DATE), RUN_DATE, days)

    return q


def q_features_onepass(spark, d):
    """All three windows and both peaks in one scan."""
    return feat.rolling_features(play_log(spark, d, D30, D0), RUN_DATE)


def q_features_maintained(spark, d):
    """A6 from a stored state: five days before the run date without one earlier day, then advanced day by day;
    the missing day comes late, and one day is sent again."""
    late, again, first = shift_day(RUN_DATE, 9), shift_day(RUN_DATE, 3), shift_day(RUN_DATE, 5)
    state = FeatureState(spark, scratch_path(spark, f"features-{uuid.uuid4().hex}"))
    plays = play_log(spark, d, D30, D0)
    state.advance(plays.where(F.col("dt_data") != F.lit(late)), first)
    for back, changed in ((4, ()), (3, ()), (2, (late,)), (1, (again,)), (0, ())):
        day = shift_day(RUN_DATE, back)
        state.advance(plays, day, changed)
    return features_of_state(state.of(RUN_DATE))


def q_peak_day(spark, d):
    return feat.peak_days(play_log(spark, d, D30, D0), RUN_DATE, per_key=True)


def q_peak_day_global(spark, d):
    return feat.peak_days(play_log(spark, d, D30, D0), RUN_DATE, per_key=False)


def q_daily_count(spark, d):
    """A4: plays per (day, song) over the 31-day window."""
    return feat.daily_counts(play_log(spark, d, D30, D0), D30, D0)


def song_feature_table(spark, d):
    """tw_song_play_feature_d for RUN_DATE: every song of the whole play
    history with its features (NULL where inactive)."""
    history = song_plays(spark, d)
    feats = feat.rolling_features(song_plays(spark, d, D30, D0), RUN_DATE)
    return feat.feature_wide(history, feats, "songid", ["songname", "singer1"])


def q_feature_wide(spark, d):
    return song_feature_table(spark, d)


def _rsi_cols(df):
    return [F.round(F.col(c), R6).alias(c) for c in ("RSI_1", "RSI_7", "RSI_30")]


def q_rsi_song(spark, d):
    scored = with_rsi(song_feature_table(spark, d))
    return scored.select("songid", *_rsi_cols(scored))


def q_rank_song(spark, d):
    scored = with_rsi(song_feature_table(spark, d)).withColumn("dt_data", F.lit(RUN_DATE))
    ids = ["songid", "songname", "singer1"]
    ranked = rank_by_period(scored, ids, ids)
    return ranked.select(
        "period", "songid", "songname", "singer1", F.round("RSI", R6).alias("RSI"), "RSI_RANK", "dt_data"
    )


def q_rsi_singer(spark, d):
    scored = with_rsi(singer_features(song_feature_table(spark, d)))
    return scored.select("singer1", *[F.col(c) for c in scored.columns if c.startswith("per") or c.startswith("top")],
                         *_rsi_cols(scored))


def q_rank_singer_global(spark, d):
    scored = with_rsi(singer_features(song_feature_table(spark, d)))
    ranked = rank_by_period(scored, ["singer1"], ["singer1"], day_col=None)
    return ranked.select("period", "singer1", F.round("RSI", R6).alias("RSI"), "RSI_RANK")


RANK_TIES = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_shipdate")


def _rank_lines(descending):
    def q(spark, d):
        li = table(spark, d, "lineitem").select("l_suppkey", "l_extendedprice", *RANK_TIES, "l_returnflag")
        ties = [*RANK_TIES, "l_returnflag"]
        return rank_rows(li, ["l_extendedprice"], ["l_suppkey"], ties, "price_rank", descending, num_ranges=16)

    return q


QUERIES = {
    "song_play_join": q_song_play_join,
    "features_1d": _features_window(0),
    "features_7d": _features_window(7),
    "features_30d": _features_window(30),
    "features_onepass": q_features_onepass,
    "features_maintained": q_features_maintained,
    "daily_count": q_daily_count,
    "peak_day": q_peak_day,
    "peak_day_global": q_peak_day_global,
    "feature_wide": q_feature_wide,
    "rsi_song": q_rsi_song,
    "rank_song": q_rank_song,
    "rsi_singer": q_rsi_singer,
    "rank_singer_global": q_rank_singer_global,
    "rank_lines": _rank_lines(False),  # W1 over a whole fact table, payload columns, 16 ranges
    "rank_lines_desc": _rank_lines(True),  # D4: highest first
}

# ---------------------------------------------------------------- oracle SQL

PLAYS = """plays AS (
  SELECT json_extract_string(props, '$.k') AS songid,
         CAST(user_id AS VARCHAR) AS uid,
         CASE WHEN event_type = 'purchase' THEN CAST(event_id AS VARCHAR) END AS order_id,
         strftime(ts, '%Y%m%d') AS dt_data
  FROM events)"""

SONGPLAYS = PLAYS + """,
songplays AS (
  SELECT p.songid, s.p_name AS songname, s.p_brand AS singer1, p.uid, p.order_id, p.dt_data
  FROM plays p JOIN part s ON p.songid = CAST(s.p_partkey AS VARCHAR))"""


def _win_sql(src, label, lo):
    return f"""SELECT songid,
         count(songid) AS per{label}SongNBM,
         0 AS per{label}SongSuppNBM,
         count(DISTINCT uid) AS per{label}UserSongNBM,
         count(DISTINCT order_id) AS per{label}OrderSongNBM
  FROM {src} WHERE dt_data BETWEEN '{lo}' AND '{D0}' GROUP BY songid"""


def _features_sql(src):
    return f"""w1 AS ({_win_sql(src, '', D0)}),
w7 AS ({_win_sql(src, 'Seven', D7)}),
w30 AS ({_win_sql(src, 'Thirty', D30)}),
top AS (
  SELECT songid,
         max(CASE WHEN dt_data BETWEEN '{D7}' AND '{D0}' THEN cnt ELSE 0 END) AS top7day,
         max(CASE WHEN dt_data BETWEEN '{D30}' AND '{D0}' THEN cnt ELSE 0 END) AS top30day
  FROM (SELECT dt_data, songid, count(songid) AS cnt FROM {src}
        WHERE dt_data BETWEEN '{D30}' AND '{D0}' GROUP BY dt_data, songid) o
  GROUP BY songid),
feats AS (
  SELECT w30.songid,
         w1.perSongNBM, w1.perSongSuppNBM, w1.perUserSongNBM, w1.perOrderSongNBM,
         w7.perSevenSongNBM, w7.perSevenSongSuppNBM, w7.perSevenUserSongNBM, w7.perSevenOrderSongNBM,
         w30.perThirtySongNBM, w30.perThirtySongSuppNBM, w30.perThirtyUserSongNBM, w30.perThirtyOrderSongNBM,
         top.top7day, top.top30day
  FROM w30 LEFT JOIN w1 ON w30.songid IS NOT DISTINCT FROM w1.songid
           LEFT JOIN w7 ON w30.songid IS NOT DISTINCT FROM w7.songid
           LEFT JOIN top ON w30.songid IS NOT DISTINCT FROM top.songid)"""


WIDE = SONGPLAYS + ",\n" + _features_sql("songplays") + """,
wide AS (
  SELECT DISTINCT z.songid, z.songname, z.singer1,
         f.perSongNBM, f.perSongSuppNBM, f.perUserSongNBM, f.perOrderSongNBM,
         f.perSevenSongNBM, f.perSevenSongSuppNBM, f.perSevenUserSongNBM, f.perSevenOrderSongNBM,
         f.perThirtySongNBM, f.perThirtySongSuppNBM, f.perThirtyUserSongNBM, f.perThirtyOrderSongNBM,
         f.top7day, f.top30day
  FROM songplays z LEFT JOIN feats f ON z.songid = f.songid)"""


def _rsi_sql(p):
    return f"""pow(ln({p}perSongNBM/1+1)*0.63*0.8 + ln({p}perSongSuppNBM/1+1)*0.63*0.2, 2)*10 AS RSI_1,
       pow((ln({p}perSevenSongNBM/7+1)*0.63*0.8 + ln({p}perSevenSongSuppNBM/7+1)*0.2)
           + ln({p}top7day/7+1)*0.37*0.8, 2) AS RSI_7,
       pow((ln({p}perThirtySongNBM/7+1)*0.63*0.8 + ln({p}perThirtySongSuppNBM/7+1)*0.2)
           + ln({p}top30day/7+1)*0.37*0.8, 2) AS RSI_30"""


SINGER = WIDE + """,
singer AS (
  SELECT singer1,
    CAST(sum(perSongNBM) AS BIGINT) AS perSongNBM, CAST(sum(perSongSuppNBM) AS BIGINT) AS perSongSuppNBM,
    CAST(sum(perUserSongNBM) AS BIGINT) AS perUserSongNBM, CAST(sum(perOrderSongNBM) AS BIGINT) AS perOrderSongNBM,
    CAST(sum(perSevenSongNBM) AS BIGINT) AS perSevenSongNBM, CAST(sum(perSevenSongSuppNBM) AS BIGINT) AS perSevenSongSuppNBM,
    CAST(sum(perSevenUserSongNBM) AS BIGINT) AS perSevenUserSongNBM, CAST(sum(perSevenOrderSongNBM) AS BIGINT) AS perSevenOrderSongNBM,
    CAST(sum(perThirtySongNBM) AS BIGINT) AS perThirtySongNBM, CAST(sum(perThirtySongSuppNBM) AS BIGINT) AS perThirtySongSuppNBM,
    CAST(sum(perThirtyUserSongNBM) AS BIGINT) AS perThirtyUserSongNBM, CAST(sum(perThirtyOrderSongNBM) AS BIGINT) AS perThirtyOrderSongNBM,
    CAST(sum(top7day) AS BIGINT) AS top7day, CAST(sum(top30day) AS BIGINT) AS top30day
  FROM wide GROUP BY singer1),
singer_rsi AS (SELECT *, """ + _rsi_sql("") + """ FROM singer)"""


def _rank_union(src, ids, part):
    parts = []
    for period in ("1", "7", "30"):
        pb = f"PARTITION BY {part} " if part else ""
        parts.append(
            f"""SELECT '{period}' AS period, {ids}, round(RSI_{period}, {R6}) AS RSI,
         CAST(row_number() OVER ({pb}ORDER BY RSI_{period} ASC NULLS FIRST, {ids.split(',')[0]}) AS INTEGER) AS RSI_RANK"""
            + (f", '{RUN_DATE}' AS dt_data" if part else "")
            + f"\n  FROM {src}"
        )
    return "\nUNION ALL\n".join(parts)


def _rank_lines_sql(order):
    ties = [*RANK_TIES, "l_returnflag"]
    by = ", ".join(f"{c} {order}" for c in ["l_extendedprice", *ties])
    cols = ", ".join(["l_suppkey", "l_extendedprice", *ties])
    return f"""SELECT {cols}, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY {by}) AS INTEGER) AS price_rank
FROM lineitem"""


ORACLE = {
    "song_play_join": SONGPLAYS + f"""
SELECT songid, songname, singer1, uid, order_id, dt_data FROM songplays WHERE dt_data = '{D0}'""",
    "features_1d": PLAYS + f"\n{_win_sql('plays', '', D0)}",
    "features_7d": PLAYS + f"\n{_win_sql('plays', 'Seven', D7)}",
    "features_30d": PLAYS + f"\n{_win_sql('plays', 'Thirty', D30)}",
    "features_onepass": "WITH " + PLAYS + ",\n" + _features_sql("plays") + "\nSELECT * FROM feats",
    "daily_count": "WITH " + PLAYS + f"""
SELECT dt_data, songid, count(songid) AS cnt FROM plays
WHERE dt_data BETWEEN '{D30}' AND '{D0}' GROUP BY dt_data, songid""",
    "peak_day": "WITH " + PLAYS + ",\n" + _features_sql("plays") + "\nSELECT * FROM top WHERE songid IS NOT NULL",
    "peak_day_global": "WITH " + PLAYS + f"""
SELECT min(o.songid) AS songid,
       max(CASE WHEN o.dt_data BETWEEN '{D7}' AND '{D0}' THEN o.cnt ELSE 0 END) AS top7day,
       max(CASE WHEN o.dt_data BETWEEN '{D30}' AND '{D0}' THEN o.cnt ELSE 0 END) AS top30day
FROM (SELECT dt_data, songid, count(songid) AS cnt FROM plays
      WHERE dt_data BETWEEN '{D30}' AND '{D0}' GROUP BY dt_data, songid) o""",
    "feature_wide": "WITH " + WIDE + "\nSELECT * FROM wide",
    "rsi_song": "WITH " + WIDE + f"""
SELECT songid, round(RSI_1, {R6}) AS RSI_1, round(RSI_7, {R6}) AS RSI_7, round(RSI_30, {R6}) AS RSI_30
FROM (SELECT songid, {_rsi_sql('')} FROM wide) r""",
    "rank_song": "WITH " + WIDE + ",\nscored AS (SELECT *, " + _rsi_sql("") + " FROM wide)\n"
    + _rank_union("scored", "songid, songname, singer1", "'x'"),
    "rsi_singer": "WITH " + SINGER + f"""
SELECT singer1, perSongNBM, perSongSuppNBM, perUserSongNBM, perOrderSongNBM,
       perSevenSongNBM, perSevenSongSuppNBM, perSevenUserSongNBM, perSevenOrderSongNBM,
       perThirtySongNBM, perThirtySongSuppNBM, perThirtyUserSongNBM, perThirtyOrderSongNBM,
       top7day, top30day,
       round(RSI_1, {R6}) AS RSI_1, round(RSI_7, {R6}) AS RSI_7, round(RSI_30, {R6}) AS RSI_30
FROM singer_rsi""",
    "rank_singer_global": "WITH " + SINGER + "\n" + _rank_union("singer_rsi", "singer1", ""),
    "rank_lines": _rank_lines_sql("ASC NULLS FIRST"),
    "rank_lines_desc": _rank_lines_sql("DESC NULLS LAST"),
}
ORACLE["features_maintained"] = ORACLE["features_onepass"]
for _k in ("song_play_join", "features_1d", "features_7d", "features_30d"):
    ORACLE[_k] = "WITH " + ORACLE[_k]
