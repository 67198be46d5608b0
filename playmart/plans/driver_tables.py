"""Role mapping from the driver's TPC-H-like tables to the song-machine model.

events   -> play log (song = props.k, user = user_id, order = purchase event id,
            day = ts as yyyyMMdd)
part     -> song catalogue
supplier -> machines (province = nation, operator = region)
lineitem ⨝ orders -> payment orders (machine = l_suppkey, package =
            l_linenumber, pay type = l_orderkey % 9, user = o_custkey,
            returnflag N/A/R -> raw order type 1/2/other)
customer -> registered users (4 channels by c_custkey % 4)

Every adapter is a projection over a full table scan, so the work of every
query grows with the tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed run date of the registered song queries (inside the events range).
RUN_DATE = "20240125"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ts_bounds(start: str, end: str):
    lo = _dt.datetime.strptime(start, "%Y%m%d")
    hi = _dt.datetime.strptime(end, "%Y%m%d") + _dt.timedelta(days=1)
    return lo, hi


def play_log(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """events as the song play log (songid, uid, order_id, dt_data).

    With ``start``/``end`` a timestamp range is added so the day range also
    reaches the Parquet scan as a pushed filter.
    """
    ev = table(spark, sf_dir, "events")
    if start is not None and end is not None:
        lo, hi = _ts_bounds(start, end)
        ev = ev.where((F.col("ts") >= F.lit(lo)) & (F.col("ts") < F.lit(hi)))
    return ev.select(
        F.get_json_object("props", "$.k").alias("songid"),
        F.col("user_id").cast("string").alias("uid"),
        F.when(F.col("event_type") == "purchase", F.col("event_id").cast("string")).alias("order_id"),
        F.date_format("ts", "yyyyMMdd").alias("dt_data"),
    )


def song_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as the song catalogue: id, name, singer (brand), duration (size)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("source_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("singer1"),
        F.col("p_type").alias("language"),
        F.col("p_size").alias("duration"),
    )


def song_plays(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Play log joined to the song catalogue (the DWM play table)."""
    from playmart.operators.relational import join_dim

    plays = play_log(spark, sf_dir, start, end)
    return join_dim(plays, song_dim(spark, sf_dir), "songid", "source_id").select(
        "songid",
        F.col("name").alias("songname"),
        "singer1",
        "language",
        "duration",
        "uid",
        "order_id",
        "dt_data",
    )
