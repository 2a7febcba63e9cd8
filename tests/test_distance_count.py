"""Pairs within a radius counted by cells, against the join that forms them."""

import math
import random

import pytest
from pyspark.sql import functions as F

from homeward.operators import count_distance_pairs, distance_join
from homeward.plans import trip_table
from homeward.sources import clean_trips

POINTS = ("la", "lo"), ("lb", "mb")


def tables(spark, left, right):
    a = spark.createDataFrame([(float(x), float(y)) if x is not None else (None, y) for x, y in left] or [], "la double, lo double")
    b = spark.createDataFrame([(float(x), float(y)) if x is not None else (None, y) for x, y in right] or [], "lb double, mb double")
    return a.repartition(4), b.repartition(4)


def counted(spark, left, right, radius=100.0, near=64, **kw):
    a, b = tables(spark, left, right)
    found = count_distance_pairs(a, b, *POINTS, radius, near=near, **kw).first()
    assert found["n"] == distance_join(a, b, *POINTS, radius, **kw).count()
    return found


def around(seed, n, lat, lon, spread):
    r = random.Random(seed)
    return [(lat + r.uniform(-spread, spread), lon + r.uniform(-spread, spread)) for _ in range(n)]


def test_trips(spark, sf_dir):
    t = trip_table(clean_trips(spark, sf_dir))
    a = t.select(F.col("dropoff_lat").alias("la"), F.col("dropoff_lon").alias("lo"))
    b = t.select(F.col("pickup_lat").alias("lb"), F.col("pickup_lon").alias("mb"))
    assert count_distance_pairs(a, b, *POINTS).first()["n"] == distance_join(a, b, *POINTS).count()


@pytest.mark.parametrize("lat, lon", [(40.7, -74.0), (78.0, 15.0), (10.0, 180.0), (-89.9995, 30.0)])
def test_places(spark, lat, lon):
    """Dense places, also on the antimeridian and the polar caps (where some
    of the points are off the earth)."""
    left, right = around(1, 120, lat, lon, 0.0015), around(2, 120, lat, lon, 0.0015)
    wrapped = [(x, y - 360 if y > 180 else y + 360 if y < -180 else y) for x, y in left]
    assert counted(spark, wrapped, right)["n"] > 0


def test_rim(spark):
    """Points on a circle whose radius is the limit, within rounding."""
    rim = [(40.7 + math.degrees(100 / 6371e3) * (1 + k * 1e-9), -74.0) for k in range(-60, 60)]
    found = counted(spark, [(40.7, -74.0)] * 3, rim)
    assert 0 < found["n"] < 360


def test_dense_place_compares_its_rim_only(spark):
    """20,000 points a side within 60 m of a place pair wholly; twice as wide, the rim
    is a small part."""
    a = spark.range(20000).select((40.7 + F.rand(1) * 2e-4).alias("la"), (-74.0 + F.rand(2) * 2e-4).alias("lo"))
    b = spark.range(20000).select((40.7 + F.rand(3) * 2e-4).alias("lb"), (-74.0 + F.rand(4) * 2e-4).alias("mb"))
    found = count_distance_pairs(a, b, *POINTS).first()
    assert (found["n"], found["compared"]) == (400_000_000, 0)
    wide = [d.select(F.col(x) + F.rand(5) * 2e-3, F.col(y) + F.rand(6) * 2e-3).toDF(x, y) for d, (x, y) in ((a, POINTS[0]), (b, POINTS[1]))]
    found = count_distance_pairs(*wide, *POINTS).first()
    assert 0 < found["compared"] < 0.25 * found["n"]


def test_equal_points_are_one(spark):
    a = spark.range(3_000_000).select(F.lit(40.7).alias("la"), F.lit(-74.0).alias("lo"))
    b = a.toDF("lb", "mb")
    found = count_distance_pairs(a, b, *POINTS).first()
    assert found["n"] == 9 * 10**12 and found["compared"] <= 9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(None, 1.0), (nan, 1.0), (1.0, nan), (inf, 1.0), (-inf, 1.0), (0.0, 0.0), (-0.0, 0.0), (95.0, 10.0), (95.0, 10.0), (1e300, 5.0), (40.7, 181.0), (40.7, 181.0)]
    assert counted(spark, odd, odd)["n"] >= 4
    assert counted(spark, odd, odd, near=0)["n"] >= 4
    assert counted(spark, [], odd)["n"] == 0
    assert counted(spark, odd, [])["n"] == 0
    assert counted(spark, [], [])["n"] == 0
    same = around(3, 50, 40.7, -74.0, 1e-3)
    assert counted(spark, same, same, radius=0.0)["n"] == 50
    with pytest.raises(ValueError):
        count_distance_pairs(*tables(spark, odd, odd), *POINTS, -1.0)
