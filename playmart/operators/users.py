"""Users: four registration channels -> one table; daily and rolling logins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.functions.dates import login_date
from playmart.operators.ranking import rolling_sum
from playmart.operators.relational import map_source, union_sources

# The columns of the unified user table.
USER_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in (
        "uid", "reg_mid", "reg_channel", "ref_channelid", "ref_uid", "sex", "birthday", "msisdn",
        "locationid", "mode_type", "regist_time", "user_exp", "score", "user_level", "user_type",
        "is_certified", "is_student_certified",
    )]
)

# Channel name, channel id, source id column, per-channel constants.
CHANNELS = {
    "wechat": {"id": "1", "ref_uid": "wxid", "const": {"user_type": "2", "is_certified": "T", "is_student_certified": "F"}},
    "alipay": {"id": "2", "ref_uid": "openid", "const": {}},
    "QQ": {"id": "3", "ref_uid": "openid", "const": {"user_type": "2", "is_certified": "T", "is_student_certified": "F"}},
    "app": {"id": "4", "ref_uid": "app_uid", "renames": {"msisdn": "phone_number"},
            "const": {"mode_type": "0", "score": "0", "user_type": "2", "is_certified": "T", "is_student_certified": "F"}},
}


def channel_users(df: DataFrame, channel: str, optional=None) -> DataFrame:
    """Map one channel's registrations onto USER_SCHEMA by name. With ``optional``
    only the columns named there may be absent (see ``map_source``)."""
    spec = CHANNELS[channel]
    renames = {"ref_uid": spec["ref_uid"], **spec.get("renames", {})}
    consts = {"reg_channel": channel, "ref_channelid": spec["id"], **spec["const"]}
    return map_source(df, USER_SCHEMA, renames, consts, optional)


def unify_users(sources: dict[str, DataFrame], optional=None) -> DataFrame:
    """UNION ALL of the channels present in ``sources`` (map-only, no shuffle)."""
    return union_sources([channel_users(df, ch, optional) for ch, df in sources.items()])


def daily_logins(logins: DataFrame, users: DataFrame, snapshot_day: str | None = None) -> DataFrame:
    """Logins per day: ``count(uid)`` of logins joined to the user table.

    Every user snapshot row matches (a user present in k snapshots counts k
    times), as in the original; ``snapshot_day`` restricts the user table to
    one snapshot. Bad / empty / NULL login times are dropped.
    """
    if snapshot_day is not None and "dt_data" in users.columns:
        users = users.where(F.col("dt_data") == F.lit(snapshot_day))
    # Pre-aggregate both sides to one row per user (and day) before the join:
    # a hot user or a user with many snapshots is then one row, not a skewed
    # partition, and count = sum(logins x snapshot rows).
    days = (
        logins.select("uid", login_date("logintime").alias("loginTm"))
        .where(F.col("loginTm").isNotNull() & F.col("uid").isNotNull())
        .groupBy("uid", "loginTm")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    snaps = users.where(F.col("uid").isNotNull()).groupBy("uid").agg(F.count(F.lit(1)).alias("_k"))
    joined = days.join(snaps, "uid", "inner")
    return (
        joined.groupBy("loginTm")
        .agg(F.sum(F.col("_n") * F.col("_k")).alias("user_cnt"))
        .orderBy("loginTm")
    )


def rolling_logins(daily: DataFrame, rows: int = 8) -> DataFrame:
    """Rolling login count over the current day row and the 7 rows before it."""
    return rolling_sum(daily, "loginTm", "user_cnt", rows=rows, out="week_user_cnt").select(
        "loginTm", F.col("week_user_cnt").cast("long").alias("week_user_cnt")
    )
