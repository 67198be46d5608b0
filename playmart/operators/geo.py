"""Machine location enrichment.

The original asks a web reverse-geocoder once per machine row. Here the
lookup is a join against a table of places (street numbers with their
province, city, township, street, number and coordinates):

* every coordinate is a point on a sphere, and space is cut into cubes whose
  side is the chord of the search radius, so a place within the radius lies in
  the point's cube or one of its neighbours, at any latitude and on either side
  of the 180th meridian;
* each distinct coordinate is exploded to those cubes and equi-joined on the
  cube; the optimizer decides broadcast vs shuffle by size;
* where a cube holds more than ``leaf`` places, cubes are split and searched by distance bounds
  (``geo_cells``), so a point's candidates don't grow with the places in its radius;
* haversine distance, keep places within the radius, ``min_by`` on
  (distance, place id) picks the nearest deterministically;
* the result is joined back to the location rows, one output row each.

``flatten_geo`` turns a reverse-geocoder JSON response into the same columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.operators import geo_cells
from playmart.sources.scratch import Scratch

EARTH_RADIUS_M = 6_371_008.8

# Compass names for 8 sectors starting at north, clockwise.
DIRECTIONS = ("北", "东北", "东", "东南", "南", "西南", "西", "西北")

# The column names of the location table.
LOCATION_COLS = ("mid", "addressDetail", "province", "city", "township", "street", "number", "xy", "direction", "distance")

GEO_SCHEMA = (
    "regeocode struct<formatted_address: string, addressComponent: struct<"
    "province: string, city: string, township: string, "
    "streetNumber: struct<street: string, number: string, location: string, direction: string, distance: string>>>"
)


D2R = math.pi / 180.0
R2D = 180.0 / math.pi


def _rad(c: Column) -> Column:
    return c * F.lit(D2R)


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in meters."""
    p1, p2 = _rad(lat1), _rad(lat2)
    dlat = _rad(lat2 - lat1)
    dlng = _rad(lng2 - lng1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlng / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))))


def direction(from_lat: Column, from_lng: Column, to_lat: Column, to_lng: Column) -> Column:
    """8-sector compass name of the bearing from one point to another."""
    dy = to_lat - from_lat
    dx = (to_lng - from_lng) * F.cos(_rad(from_lat))
    deg = F.atan2(dx, dy) * F.lit(R2D)
    sector = F.pmod(F.floor((deg + 22.5) / 45), F.lit(8)).cast("int")
    return F.element_at(F.array(*[F.lit(d) for d in DIRECTIONS]), sector + 1)


def _sphere(lat: Column, lng: Column) -> list[Column]:
    """The point of the unit sphere."""
    return [F.cos(_rad(lat)) * F.cos(_rad(lng)), F.cos(_rad(lat)) * F.sin(_rad(lng)), F.sin(_rad(lat))]


def _cube(lat: Column, lng: Column, side_m: float) -> list[Column]:
    """Integer coordinates of the cube that holds a point of the sphere."""
    return [F.floor(c * F.lit(EARTH_RADIUS_M / side_m)) for c in _sphere(lat, lng)]


def _in_meters(df: DataFrame, lat: str, lng: str) -> DataFrame:
    return df.withColumns({f"_{a}": c * F.lit(EARTH_RADIUS_M) for a, c in zip("xyz", _sphere(F.col(lat), F.col(lng)))})


def nearest_place(
    points: DataFrame,
    places: DataFrame,
    radius_m: float = 1_000.0,
    keep_unmatched: bool = True,
    id_col: str = "mid",
    x_col: str = "x",
    y_col: str = "y",
    place_id: str = "place_id",
    leaf: int = geo_cells.LEAF,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Nearest place within ``radius_m`` of each location row (x = latitude,
    y = longitude, as texts; rows with an empty text are skipped).

    One output row per location row, so a machine with several rows keeps all
    of them. Output columns LOCATION_COLS; ``distance`` in meters (3 decimals).
    ``keep_unmatched`` adds the original's failure row (0, "", ..., "") for
    every row with no place in range or without valid coordinates.
    """
    # A little wider than the chord, so rounding can't put a place two cubes away.
    side = 2 * EARTH_RADIUS_M * math.sin(min(radius_m / (2 * EARTH_RADIUS_M), math.pi / 2)) * 1.000001 + 1e-6
    coord = lambda c: F.when(F.isnan(c.try_cast("double")), None).otherwise(c.try_cast("double"))
    rows = points.where((F.col(x_col) != "") & (F.col(y_col) != "")).select(
        F.col(id_col).alias("_mid"), coord(F.col(x_col)).alias("_lat"), coord(F.col(y_col)).alias("_lng")
    )
    at = rows.select("_lat", "_lng").where(F.abs("_lat") <= 1e6).where(F.abs("_lng") <= 1e6).distinct()
    ring = (-1, 0, 1)
    shifts = F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy"), F.lit(c).alias("dz")) for a in ring for b in ring for c in ring])
    probe = at.select("*", *[c.alias(n) for c, n in zip(_cube(F.col("_lat"), F.col("_lng"), side), "xyz")], F.inline(shifts))
    probe = probe.select("_lat", "_lng", *[(F.col(n) + F.col(f"d{n}")).alias(f"_c{n}") for n in "xyz"])
    loc = (
        F.col("location")
        if "location" in places.columns
        else F.concat_ws(",", F.col("lng").cast("string"), F.col("lat").cast("string"))
    )
    pl = places.select(
        F.col(place_id).alias("_pid"),
        F.col("lat").alias("_plat"),
        F.col("lng").alias("_plng"),
        loc.alias("_ploc"),
        "formatted_address", "province", "city", "township", "street", "number",
        *[c.alias(f"_c{n}") for c, n in zip(_cube(F.col("lat"), F.col("lng"), side), "xyz")],
    )
    cubes = ["_cx", "_cy", "_cz"]
    densest = pl.groupBy(*cubes).count().agg(F.max("count")).first()[0] or 0
    if densest <= leaf:
        cand = probe.join(pl, cubes, "inner")
    else:
        # Of places at one coordinate the smallest id is the nearest.
        one = [c for c in pl.columns if c not in ("_plat", "_plng", *cubes)]
        distinct = pl.groupBy("_plat", "_plng").agg(F.min_by(F.struct(*one), "_pid").alias("_one")).select("_plat", "_plng", "_one.*")
        scratch = scratch or Scratch(points.sparkSession, "places")
        cand = geo_cells.candidates(_in_meters(at, "_lat", "_lng"), scratch.keep(_in_meters(distinct, "_plat", "_plng")), side, side, leaf, scratch)
    cand = cand.withColumn(
        "_dist", haversine_m(F.col("_lat"), F.col("_lng"), F.col("_plat"), F.col("_plng"))
    ).where(F.col("_dist") <= F.lit(radius_m))
    info = F.struct(
        F.col("formatted_address").alias("addressDetail"),
        "province", "city", "township", "street", "number",
        F.col("_ploc").alias("xy"),
        direction(F.col("_plat"), F.col("_plng"), F.col("_lat"), F.col("_lng")).alias("direction"),
        F.round(F.col("_dist"), 3).cast("string").alias("distance"),
    )
    best = cand.groupBy("_lat", "_lng").agg(F.min_by(info, F.struct("_dist", "_pid")).alias("_b"))
    joined = rows.join(best, ["_lat", "_lng"], "left")
    ok = F.col("_b").isNotNull()
    if not keep_unmatched:
        joined = joined.where(ok)
    mid = F.when(ok, F.col("_mid")).otherwise(F.lit(0).cast(points.schema[id_col].dataType)).alias("mid")
    return joined.select(mid, *[F.when(ok, F.col("_b")[c]).otherwise(F.lit("")).alias(c) for c in LOCATION_COLS[1:]])


def flatten_geo(df: DataFrame, json_col: str = "response", id_col: str = "mid", keep_failed: bool = True) -> DataFrame:
    """Reverse-geocoder JSON -> LOCATION_COLS. A response without
    ``regeocode`` or ``addressComponent`` (or not JSON) gives the failure row
    (0, "", ...) when ``keep_failed``, else is dropped."""
    parsed = df.select(F.col(id_col).alias("_mid"), F.from_json(F.col(json_col), GEO_SCHEMA).alias("_j"))
    rg = F.col("_j.regeocode")
    ac = rg.getField("addressComponent")
    sn = ac.getField("streetNumber")
    ok = rg.isNotNull() & ac.isNotNull() & sn.isNotNull()
    fields = {
        "addressDetail": rg.getField("formatted_address"),
        "province": ac.getField("province"),
        "city": ac.getField("city"),
        "township": ac.getField("township"),
        "street": sn.getField("street"),
        "number": sn.getField("number"),
        "xy": sn.getField("location"),
        "direction": sn.getField("direction"),
        "distance": sn.getField("distance"),
    }
    mid_t = df.schema[id_col].dataType
    cols = [F.when(ok, F.col("_mid")).otherwise(F.lit(0).cast(mid_t)).alias("mid")]
    cols += [F.when(ok, v).otherwise(F.lit("")).alias(k) for k, v in fields.items()]
    out = parsed.select(*cols, ok.alias("_ok"))
    if not keep_failed:
        out = out.where("_ok")
    return out.drop("_ok")
