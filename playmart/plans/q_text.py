"""Registered cleansing queries (F1-F13, P4, U2, S1-S3) on the driver tables.

Raw texts (album, singer JSON, addresses, log lines) are rebuilt from table
columns by plain string concatenation, identically in Spark and in the oracle,
so the cleansers run over every row of the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from playmart.functions import dates, text
from playmart.operators.relational import sentinel_split, union_sources
from playmart.plans.driver_tables import table
from playmart.sources import logs


def _cat(*parts):
    return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])


def _s(c):
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# ------------------------------------------------------------------ songs


def song_texts(spark, d):
    p = table(spark, d, "part")
    k = F.col("p_size") % 5
    album = (
        F.when(k == 0, _cat(F.col("p_brand"), "《", F.col("p_name"), "》 vol ", _s("p_size")))
        .when(k == 1, _cat("《", F.col("p_name"), "》x《", F.col("p_brand"), "》"))
        .when(k == 2, F.col("p_name"))
        .when(k == 3, _cat("》", F.col("p_name"), "《"))
    )
    singer = (
        F.when(k == 0, _cat('[{"name":"', F.col("p_brand"), '","id":"', _s("p_partkey"),
                            '"},{"name":"', F.col("p_name"), '","id":"x"}]'))
        .when(k == 1, _cat('[{"id":"', _s("p_partkey"), '"}]'))
        .when(k == 2, F.lit("[]"))
        .when(k == 3, F.lit("bad"))
        .otherwise(_cat('{"name":"', F.col("p_brand"), '"}'))
    )
    company = (
        F.when(k == 0, _cat('{"name":"', F.col("p_brand"), '","id":"', _s("p_partkey"), '"}'))
        .when(k == 1, _cat('{"id":"', _s("p_partkey"), '"}'))
        .when(k == 2, F.lit("[1]"))
        .when(k == 3, F.lit("{bad"))
    )
    publish = (
        F.when(k == 0, _cat("[", _s(F.col("p_size") % 10), ".0,", _s("p_size"), ".0]"))
        .when(k == 1, _cat("[", _s("p_size"), ".5,x,3]"))
        .when(k == 2, _cat("[,", _s("p_size"), "]"))
        .when(k == 3, _cat(_s("p_size"), ",3"))
        .otherwise(_cat("[-", _s("p_size"), ".9]"))
    )
    return p.select(
        F.col("p_partkey").alias("source_id"),
        album.alias("album_raw"),
        singer.alias("singer_info"),
        company.alias("authorized_company"),
        publish.alias("publish_to"),
    )


def q_album_title(spark, d):
    t = song_texts(spark, d)
    return t.select("source_id", text.album("album_raw").alias("album"))


def q_singer_slots(spark, d):
    t = song_texts(spark, d)
    s = F.col("singer_info")
    return t.select(
        "source_id",
        text.singer(s, 1, "name").alias("singer1"),
        text.singer(s, 1, "id").alias("singerid1"),
        text.singer(s, 2, "name").alias("singer2"),
        text.singer(s, 2, "id").alias("singerid2"),
        text.singer(s, 2, "name", second_index=1).alias("singer2_next"),
    )


def q_company_name(spark, d):
    t = song_texts(spark, d)
    return t.select("source_id", text.company("authorized_company").alias("company"))


def q_publish_list(spark, d):
    t = song_texts(spark, d)
    return t.select("source_id", text.int_list("publish_to").alias("publish_to"))


# Every accepted form of the order date, two refused ones and NULL; the flag says whether it is accepted.
POST_FORMS = (
    ("MMM d, yyyy h:mm:ss a", True),
    ("yyyy-MM-dd", False),
    ("'zz'", False),
    (None, False),
    ("EEE MMM dd HH:mm:ss 'GMT' yyyy", True),
    ("MMM d yyyy", True),
    ("d MMMM yyyy", True),
    ("M/d/yy", True),
    ("M/d/yyyy H:mm:ss", True),
    ("yyyy/MM/dd HH:mm", True),
)


def post_texts(spark, d):
    o = table(spark, d, "orders")
    k, raw = F.col("o_orderkey") % len(POST_FORMS), F.lit(None).cast("string")
    for i, (form, _) in enumerate(POST_FORMS):
        if form:
            raw = F.when(k == i, F.date_format("o_orderdate", form)).otherwise(raw)
    return o.select(F.col("o_orderkey"), raw.alias("post_time"))


def q_post_date(spark, d):
    t = post_texts(spark, d)
    return t.select(
        "o_orderkey",
        dates.post_date("post_time").alias("post_date"),
        dates.date_text("post_time").alias("date_text"),
    )


# --------------------------------------------------------------- machines


def machine_local(spark, d):
    """supplier ⨝ nation ⨝ region as the machine location table, addresses
    built with province / autonomous-region / city markers and sentinels."""
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    k = F.col("s_suppkey") % 6
    address = (
        F.when(k == 0, _cat(F.col("n_name"), "省", F.col("s_name"), "市南山"))
        .when(k == 1, _cat(F.col("n_name"), "自治区", F.col("s_name"), "市x"))
        .when(k == 2, _cat(F.col("s_name"), "市朝阳"))
        .when(k == 3, F.lit("无"))
        .when(k == 4, F.lit("null"))
        .otherwise(F.lit("市a省b"))
    )
    k3 = F.col("s_suppkey") % 7
    province = F.when(k3 < 3, F.lit("null")).when(k3 == 3, F.lit(None)).otherwise(F.col("n_name"))
    city = F.when(k3 < 2, F.lit("null")).when(k3 == 6, F.lit("null")).otherwise(F.col("r_name"))
    k2 = F.col("s_suppkey") % 3
    revenue_time = F.when(k2 == 0, F.lit("null")).when(k2 == 1, F.lit(None)).otherwise(F.lit("20200101000000"))
    sale_time = F.when(k2 == 1, F.lit("null")).otherwise(F.lit("20210101000000"))
    return j.select(
        F.col("s_suppkey").alias("mid"),
        province.alias("province"),
        city.alias("city"),
        address.alias("address"),
        revenue_time.alias("revenue_time"),
        sale_time.alias("sale_time"),
    )


def q_province_city(spark, d):
    m = machine_local(spark, d)
    return m.select("mid", text.province("address").alias("province"), text.city("address").alias("city"))


def q_default_time(spark, d):
    m = machine_local(spark, d)
    return m.select(
        "mid",
        text.default_time("revenue_time").alias("revenue_time"),
        text.default_time("sale_time").alias("sale_time"),
    )


def machine_locations(local):
    """Native rows as they are + derived rows parsed from the address."""
    native, derived = sentinel_split(local)
    derived = derived.select(
        "mid",
        text.province("address").alias("province"),
        text.city("address").alias("city"),
        "address",
        text.default_time("revenue_time").alias("revenue_time"),
        text.default_time("sale_time").alias("sale_time"),
    )
    return union_sources([native.select(*derived.columns), derived])


def q_machine_union(spark, d):
    return machine_locations(machine_local(spark, d))


# ------------------------------------------------------------------- logs


def log_lines(spark, d):
    """events rebuilt as ``&``-separated 6-field lines; some lines end with a
    trailing separator (still 6 fields), lose a field or gain one."""
    e = table(spark, d, "events")
    k = F.col("event_id") % 10
    play = F.col("event_type") == "view"
    payload = F.when(
        play,
        _cat('{"songid":"', F.get_json_object("props", "$.k"), '","mid":"', _s(F.col("event_id") % 100),
             '","uid":"', _s("user_id"), '","order_id":"', _s("event_id"), '"}'),
    ).otherwise(F.col("props"))
    etype = F.when(play, F.lit(logs.PLAY_EVENT)).otherwise(F.col("event_type"))
    base = F.concat_ws("&", _s("event_id"), F.date_format("ts", "yyyyMMddHHmmss"), etype, payload, _s("user_id"))
    line = (
        F.when(k == 0, _cat(base, "&v&"))
        .when(k == 1, _cat(base, "&"))
        .when(k == 2, _cat(base, "&v&x"))
        .otherwise(_cat(base, "&v"))
    )
    return e.select(line.alias("value"))


def q_log_split_filter(spark, d):
    parts = logs.split_log(log_lines(spark, d))
    return parts.select(F.get("parts", 0).alias("f0"), F.get("parts", 2).alias("f2"), F.get("parts", 5).alias("f5"))


def q_log_route_count(spark, d):
    routed = logs.route_log(logs.split_log(log_lines(spark, d)))
    return routed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def q_log_json_fields(spark, d):
    routed = logs.route_log(logs.split_log(log_lines(spark, d)))
    plays = logs.play_fields(routed.where(F.col("event_type") == logs.PLAY_EVENT))
    return plays.select("*", logs.join_record(logs.PLAY_FIELDS).alias("record"))


def q_log_missing_text(spark, d):
    """L1: a field that no record has counts as one distinct text ``null`` as stored, and as none if NULL."""
    plays = logs.play_fields(logs.route_log(logs.split_log(log_lines(spark, d))).where(F.col("event_type") == logs.PLAY_EVENT))
    return plays.groupBy("songid").agg(
        F.count_distinct(text.null_text(F.col("pkg_id"))).alias("n_stored"),
        F.count_distinct("pkg_id").alias("n_null"),
        F.count_distinct(text.null_text(F.col("order_id"))).alias("n_orders"),
    )


def q_log_failfast(spark, d):
    """The play fields with a reader that fails on bad JSON."""
    routed = logs.route_log(logs.split_log(log_lines(spark, d)))
    return logs.play_fields(routed.where(F.col("event_type") == logs.PLAY_EVENT), mode="failfast")


def q_date_minus(spark, d):
    """30 days before the order date; texts that are no day give 19700101."""
    o, k = table(spark, d, "orders"), F.col("o_orderkey") % 5
    day = F.when(k == 0, F.lit("bad")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return o.select("o_orderkey", dates.date_minus(day, 30).alias("day_30"))


QUERIES = {
    "album_title": q_album_title,
    "singer_slots": q_singer_slots,
    "company_name": q_company_name,
    "publish_list": q_publish_list,
    "post_date": q_post_date,
    "province_city": q_province_city,
    "default_time": q_default_time,
    "machine_union": q_machine_union,
    "log_split_filter": q_log_split_filter,
    "log_route_count": q_log_route_count,
    "log_json_fields": q_log_json_fields,
    "log_missing_text": q_log_missing_text,
    "log_failfast": q_log_failfast,
    "date_minus": q_date_minus,
}

# ---------------------------------------------------------------- oracle SQL

_ACCEPTED = ", ".join(str(i) for i, (_, accepted) in enumerate(POST_FORMS) if accepted)

SONG_TEXTS = """t AS (
  SELECT p_partkey AS source_id,
    CASE p_size % 5 WHEN 0 THEN p_brand || '《' || p_name || '》 vol ' || CAST(p_size AS VARCHAR)
                    WHEN 1 THEN '《' || p_name || '》x《' || p_brand || '》'
                    WHEN 2 THEN p_name
                    WHEN 3 THEN '》' || p_name || '《' END AS album_raw,
    CASE p_size % 5 WHEN 0 THEN '[{"name":"' || p_brand || '","id":"' || CAST(p_partkey AS VARCHAR)
                                || '"},{"name":"' || p_name || '","id":"x"}]'
                    WHEN 1 THEN '[{"id":"' || CAST(p_partkey AS VARCHAR) || '"}]'
                    WHEN 2 THEN '[]'
                    WHEN 3 THEN 'bad'
                    ELSE '{"name":"' || p_brand || '"}' END AS singer_info,
    CASE p_size % 5 WHEN 0 THEN '{"name":"' || p_brand || '","id":"' || CAST(p_partkey AS VARCHAR) || '"}'
                    WHEN 1 THEN '{"id":"' || CAST(p_partkey AS VARCHAR) || '"}'
                    WHEN 2 THEN '[1]'
                    WHEN 3 THEN '{bad' END AS authorized_company,
    CASE p_size % 5 WHEN 0 THEN '[' || CAST(p_size % 10 AS VARCHAR) || '.0,' || CAST(p_size AS VARCHAR) || '.0]'
                    WHEN 1 THEN '[' || CAST(p_size AS VARCHAR) || '.5,x,3]'
                    WHEN 2 THEN '[,' || CAST(p_size AS VARCHAR) || ']'
                    WHEN 3 THEN CAST(p_size AS VARCHAR) || ',3'
                    ELSE '[-' || CAST(p_size AS VARCHAR) || '.9]' END AS publish_to
  FROM part)"""


def _singer_sql(slot_need, idx, field):
    return f"""CASE WHEN json_valid(singer_info) THEN
         CASE WHEN json_type(singer_info) = 'ARRAY' AND json_array_length(singer_info) >= {slot_need}
                   AND json_type(singer_info, '$[{idx}]') = 'OBJECT'
              THEN json_extract_string(singer_info, '$[{idx}].{field}') ELSE '' END
       ELSE '' END"""


MACHINE_LOCAL = """m AS (
  SELECT s.s_suppkey AS mid,
    CASE WHEN s.s_suppkey % 7 < 3 THEN 'null' WHEN s.s_suppkey % 7 = 3 THEN NULL ELSE n.n_name END AS province,
    CASE WHEN s.s_suppkey % 7 < 2 THEN 'null' WHEN s.s_suppkey % 7 = 6 THEN 'null' ELSE r.r_name END AS city,
    CASE s.s_suppkey % 6 WHEN 0 THEN n.n_name || '省' || s.s_name || '市南山'
                         WHEN 1 THEN n.n_name || '自治区' || s.s_name || '市x'
                         WHEN 2 THEN s.s_name || '市朝阳'
                         WHEN 3 THEN '无'
                         WHEN 4 THEN 'null'
                         ELSE '市a省b' END AS address,
    CASE s.s_suppkey % 3 WHEN 0 THEN 'null' WHEN 1 THEN NULL ELSE '20200101000000' END AS revenue_time,
    CASE s.s_suppkey % 3 WHEN 1 THEN 'null' ELSE '20210101000000' END AS sale_time
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""

PROV_POS = """CASE WHEN instr({a}, '自治区') > 0 THEN instr({a}, '自治区')
            WHEN instr({a}, '省') > 0 THEN instr({a}, '省')
            WHEN instr({a}, '市') > 0 THEN instr({a}, '市') ELSE 0 END"""


def _province_sql(a):
    p = PROV_POS.format(a=a)
    return f"COALESCE(CASE WHEN ({p}) > 1 THEN substring({a}, 1, ({p}) - 1) END, '')"


def _city_sql(a):
    p = PROV_POS.format(a=a)
    m = f"instr({a}, '市')"
    def cut(start, length):
        return f"CASE WHEN ({length}) > 0 THEN substring({a}, {start}, {length}) ELSE '' END"
    return f"""COALESCE(CASE
      WHEN instr({a}, '省') > 0 AND {m} > 0 THEN {cut(f'({p}) + 1', f'{m} - ({p}) - 1')}
      WHEN instr({a}, '自治区') > 0 AND {m} > 0 THEN {cut(f'({p}) + 3', f'{m} - ({p}) - 3')}
      WHEN {m} > 0 THEN {cut('1', f'{m} - 1')}
      ELSE '' END, '')"""


def _dt_sql(c):
    return f"CASE WHEN {c} = 'null' THEN '20150814000000' ELSE {c} END"


MACHINE_UNION_SELECT = f"""SELECT mid, province, city, address, revenue_time, sale_time FROM m
WHERE address != 'null' AND province != 'null' AND city != 'null'
UNION ALL
SELECT mid, {_province_sql('address')} AS province, {_city_sql('address')} AS city, address,
       {_dt_sql('revenue_time')} AS revenue_time, {_dt_sql('sale_time')} AS sale_time
FROM m WHERE address != 'null' AND province = 'null' AND city = 'null'"""


LOG_LINES = """lines AS (
  SELECT CASE event_id % 10 WHEN 0 THEN base || '&v&' WHEN 1 THEN base || '&'
                            WHEN 2 THEN base || '&v&x' ELSE base || '&v' END AS value
  FROM (SELECT event_id, concat_ws('&', CAST(event_id AS VARCHAR), strftime(ts, '%Y%m%d%H%M%S'),
               CASE WHEN event_type = 'view' THEN 'MINIK_CLIENT_SONG_PLAY_OPERATE_REQ' ELSE event_type END,
               CASE WHEN event_type = 'view' THEN
                 '{"songid":"' || json_extract_string(props, '$.k') || '","mid":"' || CAST(event_id % 100 AS VARCHAR)
                 || '","uid":"' || CAST(user_id AS VARCHAR) || '","order_id":"' || CAST(event_id AS VARCHAR) || '"}'
               ELSE props END,
               CAST(user_id AS VARCHAR)) AS base
        FROM events) b),
parts AS (
  SELECT string_split(regexp_replace(value, '&+$', ''), '&') AS parts FROM lines),
kept AS (SELECT parts FROM parts WHERE len(parts) = 6),
routed AS (SELECT parts[3] AS event_type, parts[4] AS payload FROM kept)"""

_PLAY_FIELD_SQL = ",\n  ".join(f"json_extract_string(payload, '$.{f}') AS {f}" for f in logs.PLAY_FIELDS)
_RECORD_SQL = " || chr(9) || ".join(f"COALESCE({f}, 'null')" for f in logs.PLAY_FIELDS)

ORACLE = {
    "album_title": "WITH " + SONG_TEXTS + """
SELECT source_id, COALESCE(regexp_extract(album_raw, '《.*》', 0), '') AS album FROM t""",
    "singer_slots": "WITH " + SONG_TEXTS + f"""
SELECT source_id,
  {_singer_sql(1, 0, 'name')} AS singer1,
  {_singer_sql(1, 0, 'id')} AS singerid1,
  {_singer_sql(2, 0, 'name')} AS singer2,
  {_singer_sql(2, 0, 'id')} AS singerid2,
  {_singer_sql(2, 1, 'name')} AS singer2_next
FROM t""",
    "company_name": "WITH " + SONG_TEXTS + """
SELECT source_id,
  CASE WHEN json_valid(authorized_company) THEN
         CASE WHEN json_type(authorized_company) = 'OBJECT'
              THEN json_extract_string(authorized_company, '$.name') ELSE '自定义曲库' END
       ELSE '自定义曲库' END AS company
FROM t""",
    "publish_list": "WITH " + SONG_TEXTS + """,
v AS (SELECT source_id, publish_to,
        list_transform(string_split(regexp_replace(trim(publish_to), '^\\[|\\]$', '', 'g'), ','),
                       lambda e: TRY_CAST(e AS DOUBLE)) AS v FROM t)
SELECT source_id,
  CASE WHEN contains(publish_to, '[') THEN
    list_transform(list_slice(v, 1, COALESCE(NULLIF(list_position(list_transform(v, lambda x: x IS NULL), true), 0) - 1, len(v))),
                   lambda x: CAST(trunc(x) AS INTEGER))
  ELSE CAST([] AS INTEGER[]) END AS publish_to
FROM v""",
    "post_date": f"""SELECT o_orderkey,
  CASE WHEN o_orderkey % {len(POST_FORMS)} IN ({_ACCEPTED}) THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '1970-01-01' END AS post_date,
  CASE WHEN o_orderkey % {len(POST_FORMS)} IN ({_ACCEPTED}) THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS date_text
FROM orders""",
    "province_city": "WITH " + MACHINE_LOCAL + f"""
SELECT mid, {_province_sql('address')} AS province, {_city_sql('address')} AS city FROM m""",
    "default_time": "WITH " + MACHINE_LOCAL + f"""
SELECT mid, {_dt_sql('revenue_time')} AS revenue_time, {_dt_sql('sale_time')} AS sale_time FROM m""",
    "machine_union": "WITH " + MACHINE_LOCAL + "\n" + MACHINE_UNION_SELECT,
    "log_split_filter": "WITH " + LOG_LINES + """
SELECT parts[1] AS f0, parts[3] AS f2, parts[6] AS f5 FROM kept""",
    "log_route_count": "WITH " + LOG_LINES + """
SELECT event_type, count(*) AS n FROM routed GROUP BY event_type""",
    "log_json_fields": "WITH " + LOG_LINES + f""",
f AS (SELECT {_PLAY_FIELD_SQL}
      FROM routed WHERE event_type = 'MINIK_CLIENT_SONG_PLAY_OPERATE_REQ')
SELECT *, {_RECORD_SQL} AS record FROM f""",
    "log_missing_text": "WITH " + LOG_LINES + f""",
f AS (SELECT {_PLAY_FIELD_SQL} FROM routed WHERE event_type = 'MINIK_CLIENT_SONG_PLAY_OPERATE_REQ')
SELECT songid, count(DISTINCT COALESCE(pkg_id, 'null')) AS n_stored, count(DISTINCT pkg_id) AS n_null,
       count(DISTINCT COALESCE(order_id, 'null')) AS n_orders FROM f GROUP BY songid""",
    "log_failfast": "WITH " + LOG_LINES + f"""
SELECT {_PLAY_FIELD_SQL} FROM routed WHERE event_type = 'MINIK_CLIENT_SONG_PLAY_OPERATE_REQ'""",
    "date_minus": """SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 2 THEN '19700101'
       ELSE strftime(o_orderdate - INTERVAL 30 DAY, '%Y%m%d') END AS day_30 FROM orders""",
}
