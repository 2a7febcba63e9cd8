"""The "reach" neighbour keys are complete: for every pair within the
radius, the partner's exact key is among the point's reach keys."""

import numpy as np
from pyspark.sql import functions as F

from homeward.functions import METRIC, UNIFORM_176, CellKeys
from helpers import hav


def _destination(lat, lon, bearing, dist):
    R = 6371e3
    d = dist / R
    la, lo, b = np.radians(lat), np.radians(lon), np.radians(bearing)
    la2 = np.arcsin(np.sin(la) * np.cos(d) + np.cos(la) * np.sin(d) * np.cos(b))
    lo2 = lo + np.arctan2(np.sin(b) * np.sin(d) * np.cos(la), np.cos(d) - np.sin(la) * np.sin(la2))
    lon2 = (np.degrees(lo2) + 180) % 360 - 180
    return np.degrees(la2), lon2


def _pairs(seed, n, lat_range, lon_range):
    rng = np.random.default_rng(seed)
    lat = rng.uniform(*lat_range, n)
    lon = rng.uniform(*lon_range, n)
    lat2, lon2 = _destination(lat, lon, rng.uniform(0, 360, n), rng.uniform(0, 100.0, n))
    keep = hav(lat, lat2, lon, lon2) <= 100.0
    return [(float(a), float(b), float(c), float(d)) for a, b, c, d in zip(lat[keep], lon[keep], lat2[keep], lon2[keep])]


def _check(spark, rows, keys):
    df = spark.createDataFrame(rows, "lat double, lon double, lat2 double, lon2 double")
    rlat, rlon = keys.reach(F.col("lat"), F.col("lon"))
    elat, elon = keys.exact(F.col("lat2"), F.col("lon2"))
    bad = df.where(~(F.array_contains(rlat, elat) & F.array_contains(rlon, elon)))
    return bad.count()


def test_reach_complete_new_york(spark):
    rows = _pairs(1, 4000, (40.5, 41.0), (-74.3, -73.7))
    assert _check(spark, rows, CellKeys(METRIC, 100.0, "reach")) == 0
    assert _check(spark, rows, CellKeys(METRIC, 100.0, "fixed")) == 0
    assert _check(spark, rows, CellKeys(UNIFORM_176, 100.0, "reach")) == 0


def test_reach_complete_high_latitude_where_fixed_is_not(spark):
    rows = _pairs(2, 4000, (75.0, 88.9), (-180.0, 180.0))
    assert _check(spark, rows, CellKeys(METRIC, 100.0, "reach")) == 0
    assert _check(spark, rows, CellKeys(METRIC, 100.0, "fixed")) > 0


def test_reach_complete_polar_cap_and_antimeridian(spark):
    rows = _pairs(3, 3000, (88.9, 90.0), (-180.0, 180.0))
    rows += _pairs(4, 3000, (-60.0, 60.0), (179.995, 180.0))
    rows += _pairs(5, 3000, (-60.0, 60.0), (-180.0, -179.995))
    assert _check(spark, rows, CellKeys(METRIC, 100.0, "reach")) == 0


def test_reach_is_within_fixed_block_where_fixed_is_complete(spark):
    df = spark.createDataFrame([(40.0 + i * 1e-4, -74.0 + i * 3e-4) for i in range(500)], "lat double, lon double")
    r = CellKeys(METRIC, 100.0, "reach").reach(F.col("lat"), F.col("lon"))
    f = CellKeys(METRIC, 100.0, "fixed").reach(F.col("lat"), F.col("lon"))
    out = df.select(
        F.size(F.array_except(r[0], f[0])).alias("a"),
        F.size(F.array_except(r[1], f[1])).alias("b"),
        (F.size(r[0]) * F.size(r[1])).alias("n"),
    )
    agg = out.agg(F.max("a"), F.max("b"), F.avg("n")).first()
    assert agg[0] == 0 and agg[1] == 0
    assert agg[2] < 9  # fewer clones than the 3 x 3 block
