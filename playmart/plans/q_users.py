"""Registered user queries: channel union, daily logins, rolling logins."""

from __future__ import annotations

from pyspark.sql import functions as F

from playmart.operators.users import daily_logins, rolling_logins, unify_users
from playmart.plans.driver_tables import table
from playmart.plans.q_revenue import channel_sources


def login_log(spark, d):
    """events as logins: uid = user_id, logintime = ts as yyyyMMddHHmmss;
    a few texts are broken (bad, empty, NULL) and must be dropped."""
    e = table(spark, d, "events")
    k = F.col("event_id") % 50
    t = (
        F.when(k == 0, F.lit("bad"))
        .when(k == 1, F.lit(""))
        .when(k == 2, F.lit(None).cast("string"))
        .otherwise(F.date_format("ts", "yyyyMMddHHmmss"))
    )
    return e.select(F.col("user_id").cast("string").alias("uid"), t.alias("logintime"))


def user_snapshots(spark, d):
    """Two snapshots of the unified users: all users, plus a second snapshot
    of the users with a positive balance (those match twice)."""
    all_users = unify_users(channel_sources(spark, d)).withColumn("dt_data", F.lit("20240101"))
    c = table(spark, d, "customer").where(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").cast("string").alias("uid")
    )
    second = all_users.drop("dt_data").join(c, "uid", "left_semi").withColumn("dt_data", F.lit("20240102"))
    return all_users.unionByName(second)


def q_user_union(spark, d):
    return unify_users(channel_sources(spark, d))


def q_daily_login(spark, d):
    return daily_logins(login_log(spark, d), user_snapshots(spark, d))


def q_rolling_login(spark, d):
    return rolling_logins(daily_logins(login_log(spark, d), user_snapshots(spark, d)))


QUERIES = {
    "user_union": q_user_union,
    "daily_login": q_daily_login,
    "rolling_login": q_rolling_login,
}

_CHANNEL_SELECT = """SELECT CAST(c_custkey AS VARCHAR) AS uid, CAST(c_nationkey AS VARCHAR) AS reg_mid,
         '{ch}' AS reg_channel, '{cid}' AS ref_channelid, c_name AS ref_uid, c_mktsegment AS sex,
         CAST(NULL AS VARCHAR) AS birthday, '{phone}' AS msisdn, CAST(NULL AS VARCHAR) AS locationid,
         {mode} AS mode_type, CAST(NULL AS VARCHAR) AS regist_time, CAST(NULL AS VARCHAR) AS user_exp,
         {score} AS score, CAST(NULL AS VARCHAR) AS user_level, {ut} AS user_type,
         {cert} AS is_certified, {scert} AS is_student_certified
  FROM customer WHERE c_custkey % 4 = {k}"""

_NULL = "CAST(NULL AS VARCHAR)"
_FIXED = {"ut": "'2'", "cert": "'T'", "scert": "'F'"}
UNIFIED = "unified AS (\n  " + "\n  UNION ALL\n  ".join(
    [
        _CHANNEL_SELECT.format(ch="wechat", cid="1", phone="139", k=0, mode=_NULL, score=_NULL, **_FIXED),
        _CHANNEL_SELECT.format(ch="alipay", cid="2", phone="138", k=1, mode=_NULL, score=_NULL,
                               ut=_NULL, cert=_NULL, scert=_NULL),
        _CHANNEL_SELECT.format(ch="QQ", cid="3", phone="137", k=2, mode=_NULL, score=_NULL, **_FIXED),
        _CHANNEL_SELECT.format(ch="app", cid="4", phone="136", k=3, mode="'0'", score="'0'", **_FIXED),
    ]
) + ")"

LOGINS = """logins AS (
  SELECT CAST(user_id AS VARCHAR) AS uid,
         CASE WHEN event_id % 50 = 0 THEN 'bad' WHEN event_id % 50 = 1 THEN ''
              WHEN event_id % 50 = 2 THEN NULL ELSE strftime(ts, '%Y%m%d%H%M%S') END AS logintime
  FROM events),
snap AS (
  SELECT uid FROM unified
  UNION ALL
  SELECT u.uid FROM unified u WHERE u.uid IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 0)),
daily AS (
  SELECT TRY_CAST(substring(l.logintime, 1, 4) || '-' || substring(l.logintime, 5, 2) || '-'
                  || substring(l.logintime, 7, 2) AS DATE) AS loginTm,
         count(l.uid) AS user_cnt
  FROM logins l JOIN snap s ON l.uid = s.uid
  WHERE TRY_CAST(substring(l.logintime, 1, 4) || '-' || substring(l.logintime, 5, 2) || '-'
                 || substring(l.logintime, 7, 2) AS DATE) IS NOT NULL
  GROUP BY 1)"""

ORACLE = {
    "user_union": "WITH " + UNIFIED + "\nSELECT * FROM unified",
    "daily_login": "WITH " + UNIFIED + ",\n" + LOGINS + "\nSELECT * FROM daily",
    "rolling_login": "WITH " + UNIFIED + ",\n" + LOGINS + """
SELECT loginTm, CAST(sum(user_cnt) OVER (ORDER BY loginTm ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS BIGINT)
       AS week_user_cnt
FROM daily""",
}
