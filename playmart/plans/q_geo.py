"""Registered location queries: nearest-place join (J8) and geo JSON flattening.

Points are machines (supplier) with coordinates derived from their keys;
places are street numbers (customer) with coordinates derived from theirs.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from playmart.operators.geo import DIRECTIONS, EARTH_RADIUS_M, flatten_geo, nearest_place
from playmart.plans.driver_tables import table

RADIUS_M = 30_000.0


def _dotted(n, head):
    s = n.cast("string")
    return F.concat(F.substring(s, 1, head), F.lit("."), F.substring(s, head + 1, 3))


def machine_points(spark, d):
    """Three location rows a machine: near places, elsewhere near places, and in the far north."""
    s = table(spark, d, "supplier").select("s_suppkey", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("j"))
    k, j = F.col("s_suppkey"), F.col("j")
    lat = F.when(j == 2, F.lit(75123).cast("long")).otherwise(20000 + (k * 29 + j * 3571) % 10000)
    x = F.when(k % 17 == 0, F.lit("")).otherwise(_dotted(lat, 2))
    y = _dotted(100000 + (k * 71 + j * 17) % 10000, 3)
    return s.select(k.alias("mid"), x.alias("x"), y.alias("y"))


def street_places(spark, d):
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    lat_i = 20000 + (k * 37) % 10000
    lng_i = 100000 + (k * 53) % 10000
    return c.select(
        k.alias("place_id"),
        (lat_i / 1000.0).alias("lat"),
        (lng_i / 1000.0).alias("lng"),
        F.concat_ws(",", _dotted(lng_i, 3), _dotted(lat_i, 2)).alias("location"),
        F.col("c_name").alias("formatted_address"),
        F.concat(F.lit("P"), (F.col("c_nationkey") % 5).cast("string")).alias("province"),
        F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("city"),
        F.col("c_mktsegment").alias("township"),
        F.concat(F.lit("S"), (k % 97).cast("string")).alias("street"),
        (k % 300).cast("string").alias("number"),
    )


def q_nearest_place(spark, d):
    found = nearest_place(machine_points(spark, d), street_places(spark, d), radius_m=RADIUS_M)
    return found.withColumn("distance", F.col("distance").try_cast("double"))


def geo_responses(spark, d):
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    k = F.col("s_suppkey") % 5
    city = F.when(k == 3, F.lit("[]")).otherwise(F.concat(F.lit('"'), F.col("n_name"), F.lit('"')))
    street = F.concat(
        F.lit('"streetNumber":{"street":"S'), (F.col("s_suppkey") % 7).cast("string"),
        F.lit('","number":"'), F.col("s_suppkey").cast("string"),
        F.lit('","location":"100.5,20.5","direction":"东","distance":"12.5"}'),
    )
    full = F.concat(
        F.lit('{"status":"1","regeocode":{"formatted_address":"'), F.col("s_name"),
        F.lit('","addressComponent":{"province":"R'), F.col("n_regionkey").cast("string"),
        F.lit('","city":'), city,
        F.lit(',"township":"T'), (F.col("s_suppkey") % 4).cast("string"), F.lit('",'),
        F.when(k == 2, F.lit('"building":{}')).otherwise(street),
        F.lit("}}}"),
    )
    resp = F.when(k == 0, F.lit('{"status":"0","info":"INVALID_USER_KEY"}')).when(k == 1, F.lit("oops")).otherwise(full)
    return j.select(F.col("s_suppkey").alias("mid"), resp.alias("response"))


def q_geo_flatten(spark, d):
    return flatten_geo(geo_responses(spark, d))


QUERIES = {
    "nearest_place": q_nearest_place,
    "geo_flatten": q_geo_flatten,
}

_D2R = repr(math.pi / 180.0)
_R2D = repr(180.0 / math.pi)
_DIRS = ", ".join(f"'{d}'" for d in DIRECTIONS)

ORACLE = {
    "nearest_place": f"""WITH pts AS (
  SELECT s_suppkey AS mid, j,
         CASE WHEN s_suppkey % 17 = 0 THEN '' ELSE
           substring(CAST(lat AS VARCHAR), 1, 2) || '.' || substring(CAST(lat AS VARCHAR), 3, 3) END AS x,
         substring(CAST(lng AS VARCHAR), 1, 3) || '.' || substring(CAST(lng AS VARCHAR), 4, 3) AS y
  FROM (SELECT s_suppkey, j, CASE WHEN j = 2 THEN 75123 ELSE 20000 + (s_suppkey * 29 + j * 3571) % 10000 END AS lat,
               100000 + (s_suppkey * 71 + j * 17) % 10000 AS lng
        FROM supplier, range(3) r(j)) q),
p AS (SELECT mid, j, TRY_CAST(x AS DOUBLE) AS lat, TRY_CAST(y AS DOUBLE) AS lng FROM pts WHERE x <> '' AND y <> ''),
pl AS (
  SELECT c_custkey AS place_id,
         (20000 + (c_custkey * 37) % 10000) / 1000.0 AS plat,
         (100000 + (c_custkey * 53) % 10000) / 1000.0 AS plng,
         substring(CAST(100000 + (c_custkey * 53) % 10000 AS VARCHAR), 1, 3) || '.' ||
         substring(CAST(100000 + (c_custkey * 53) % 10000 AS VARCHAR), 4, 3) || ',' ||
         substring(CAST(20000 + (c_custkey * 37) % 10000 AS VARCHAR), 1, 2) || '.' ||
         substring(CAST(20000 + (c_custkey * 37) % 10000 AS VARCHAR), 3, 3) AS location,
         c_name AS formatted_address, 'P' || CAST(c_nationkey % 5 AS VARCHAR) AS province,
         'C' || CAST(c_nationkey AS VARCHAR) AS city, c_mktsegment AS township,
         'S' || CAST(c_custkey % 97 AS VARCHAR) AS street, CAST(c_custkey % 300 AS VARCHAR) AS number
  FROM customer),
cand AS (
  SELECT p.mid, p.j, p.lat, p.lng, pl.*,
         {2 * EARTH_RADIUS_M!r} * asin(sqrt(
            pow(sin((pl.plat - p.lat) * {_D2R} / 2), 2)
            + cos(p.lat * {_D2R}) * cos(pl.plat * {_D2R}) * pow(sin((pl.plng - p.lng) * {_D2R} / 2), 2))) AS dist
  FROM p, pl),
best AS (
  SELECT *, row_number() OVER (PARTITION BY mid, j ORDER BY dist, place_id) AS rn
  FROM cand WHERE dist <= {RADIUS_M!r})
SELECT mid, formatted_address AS addressDetail, province, city, township, street, number, location AS xy,
       [{_DIRS}][CAST(((floor((atan2((lng - plng) * cos(plat * {_D2R}), lat - plat) * {_R2D} + 22.5) / 45) % 8) + 8) % 8 AS INTEGER) + 1] AS direction,
       round(dist, 3) AS distance
FROM best WHERE rn = 1
UNION ALL
SELECT 0 AS mid, '', '', '', '', '', '', '', '', CAST(NULL AS DOUBLE)
FROM p WHERE NOT EXISTS (SELECT 1 FROM best b WHERE b.mid = p.mid AND b.j = p.j)""",
    "geo_flatten": """WITH r AS (
  SELECT s.s_suppkey AS mid,
    CASE s.s_suppkey % 5 WHEN 0 THEN '{"status":"0","info":"INVALID_USER_KEY"}' WHEN 1 THEN 'oops' ELSE
      '{"status":"1","regeocode":{"formatted_address":"' || s.s_name || '","addressComponent":{"province":"R'
      || CAST(n.n_regionkey AS VARCHAR) || '","city":'
      || CASE WHEN s.s_suppkey % 5 = 3 THEN '[]' ELSE '"' || n.n_name || '"' END
      || ',"township":"T' || CAST(s.s_suppkey % 4 AS VARCHAR) || '",'
      || CASE WHEN s.s_suppkey % 5 = 2 THEN '"building":{}' ELSE
           '"streetNumber":{"street":"S' || CAST(s.s_suppkey % 7 AS VARCHAR) || '","number":"'
           || CAST(s.s_suppkey AS VARCHAR) || '","location":"100.5,20.5","direction":"东","distance":"12.5"}' END
      || '}}}' END AS response
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
j AS (
  SELECT mid, response,
         CASE WHEN json_valid(response) THEN
           json_extract(response, '$.regeocode.addressComponent.streetNumber') IS NOT NULL
           AND json_type(response, '$.regeocode.addressComponent.streetNumber') = 'OBJECT'
         ELSE false END AS ok
  FROM r)
SELECT CASE WHEN ok THEN mid ELSE 0 END AS mid,
  CASE WHEN ok THEN json_extract_string(response, '$.regeocode.formatted_address') ELSE '' END AS addressDetail,
  CASE WHEN ok THEN json_extract_string(response, '$.regeocode.addressComponent.province') ELSE '' END AS province,
  CASE WHEN ok THEN json_extract_string(response, '$.regeocode.addressComponent.city') ELSE '' END AS city,
  CASE WHEN ok THEN json_extract_string(response, '$.regeocode.addressComponent.township') ELSE '' END AS township,
  CASE WHEN ok THEN json_extract_string(response, '$.regeocode.addressComponent.streetNumber.street') ELSE '' END AS street,
  CASE WHEN ok THEN json_extract_string(response, '$.regeocode.addressComponent.streetNumber.number') ELSE '' END AS number,
  CASE WHEN ok THEN json_extract_string(response, '$.regeocode.addressComponent.streetNumber.location') ELSE '' END AS xy,
  CASE WHEN ok THEN json_extract_string(response, '$.regeocode.addressComponent.streetNumber.direction') ELSE '' END AS direction,
  CASE WHEN ok THEN json_extract_string(response, '$.regeocode.addressComponent.streetNumber.distance') ELSE '' END AS distance
FROM j""",
}
