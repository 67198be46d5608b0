"""Nearest place among many places within one radius, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from playmart.operators import geo, geo_cells
from playmart.sources.scratch import Scratch

PLACE = "place_id long, lat double, lng double"


def place_frame(spark, lat, lng):
    import pandas as pd

    df = spark.createDataFrame(pd.DataFrame({"place_id": np.arange(len(lat)), "lat": lat, "lng": lng}), PLACE)
    return df.select("*", *[F.concat(F.lit(c[0]), F.col("place_id").cast("string")).alias(c) for c in ("formatted_address", "province", "city", "township", "street", "number")])


def brute(points, lat, lng, radius):
    out = {}
    for i, (a, b) in enumerate(points):
        p1, p2 = np.radians(a), np.radians(lat)
        h = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lng - b) / 2) ** 2
        d = 2 * geo.EARTH_RADIUS_M * np.arcsin(np.sqrt(np.clip(h, 0, 1)))
        k = int(np.argmin(d))
        out[i] = f"f{k}" if d[k] <= radius else ""
    return out


def clustered(n, seed):
    """Places within some 900 m: spread evenly, in tight groups, on a line, and many at one spot."""
    rnd = np.random.default_rng(seed)
    k = n // 4
    even = rnd.uniform(-0.004, 0.004, (k, 2))
    groups = rnd.uniform(-0.004, 0.004, (20, 2))[rnd.integers(0, 20, k)] + rnd.normal(0, 1e-6, (k, 2))
    line = np.column_stack([np.linspace(-0.004, 0.004, k), np.full(k, 0.001)])
    spot = np.full((n - 3 * k, 2), 0.0025)
    xy = np.concatenate([even, groups, line, spot])
    return 31.2 + xy[:, 0], 121.4 + xy[:, 1]


@pytest.mark.parametrize("n", [2_000, 100_000])
def test_dense_places_equal_brute_force_with_bounded_candidates(spark, n):
    lat, lng = clustered(n, 1)
    rnd = np.random.default_rng(5)
    points = np.concatenate([np.column_stack([31.2 + rnd.uniform(-0.006, 0.006, 150), 121.4 + rnd.uniform(-0.006, 0.006, 150)]),
                             np.column_stack([lat, lng])[rnd.integers(0, n, 40)], [[31.2, 121.42], [40.0, 100.0], [31.2025, 121.4025]]])
    rows = spark.createDataFrame([(i, str(a), str(b)) for i, (a, b) in enumerate(points.tolist())], "mid long, x string, y string")
    places = place_frame(spark, lat, lng)
    exact = [(float(str(a)), float(str(b))) for a, b in points.tolist()]
    got = {r.mid: r.addressDetail for r in geo.nearest_place(rows, places, radius_m=800.0, keep_unmatched=False).collect()}
    want = {i: x for i, x in brute(exact, lat, lng, 800.0).items() if x}
    assert got == want and 150 < len(got) < len(points)
    # Candidates a point: a few leaves, however many places there are.
    side = 800.0
    at = geo._in_meters(rows.select(F.col("x").cast("double").alias("_lat"), F.col("y").cast("double").alias("_lng")).distinct(), "_lat", "_lng")
    distinct = geo._in_meters(places.groupBy(F.col("lat").alias("_plat"), F.col("lng").alias("_plng")).agg(F.min("place_id").alias("_pid")), "_plat", "_plng")
    cand = geo_cells.candidates(at, distinct, side, side, 64, Scratch(spark, "t"))
    most = cand.groupBy("_lat", "_lng").count().agg(F.max("count")).first()[0]
    assert most <= 16 * 64, most


def test_sparse_places_take_the_plain_join(spark, monkeypatch):
    monkeypatch.setattr(geo_cells, "candidates", lambda *a: 1 / 0)
    lat, lng = np.array([31.2, 31.3]), np.array([121.4, 121.5])
    rows = spark.createDataFrame([(1, "31.2001", "121.4")], "mid long, x string, y string")
    assert geo.nearest_place(rows, place_frame(spark, lat, lng)).first().addressDetail == "f0"


def test_poles_date_line_and_empty(spark):
    rnd = np.random.default_rng(3)
    lat = np.concatenate([rnd.uniform(89.99, 90, 400), rnd.uniform(-0.01, 0.01, 400)])
    lng = np.concatenate([rnd.uniform(-180, 180, 400), np.where(rnd.random(400) < 0.5, 179.995, -179.995) + rnd.uniform(-0.004, 0.004, 400)])
    points = [(89.997, 10.0), (90.0, 0.0), (0.0, 179.9999), (0.002, -179.9999)]
    rows = spark.createDataFrame([(i, str(a), str(b)) for i, (a, b) in enumerate(points)], "mid long, x string, y string")
    got = {r.mid: r.addressDetail for r in geo.nearest_place(rows, place_frame(spark, lat, lng), radius_m=3_000.0, leaf=8).collect()}
    assert got == brute(points, lat, lng, 3_000.0)
    assert geo.nearest_place(rows.where("mid < 0"), place_frame(spark, lat, lng), radius_m=3_000.0, leaf=8).count() == 0
