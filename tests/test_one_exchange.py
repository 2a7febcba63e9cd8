"""Rows that travel once for both roles, clones by arithmetic, and distances
without trigonometry."""

import math
import random

import pytest
from pyspark.sql import functions as F

from helpers import all_pairs, as_bag
from homeward.catalog import QUERIES, with_epoch_seconds
from homeward.functions.geo import cos_lat, haversine_m, within
from homeward.operators import distance_gap_join
from homeward.plans import Layout, match_adjacent_slots, match_return_trips, trip_table
from homeward.plans.return_trips import CANONICAL_SPEC, _prepare, _wide_rows, _wide_slots
from homeward.sources import clean_trips
from homeward.sources.schema import YELLOW_CAB

T0 = 1451606400


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [plan.initialPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            found.append(node)
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_both_roles_read_one_exchange(spark, sf_dir):
    """Each role had an exchange of its own, even where it needs fewer columns."""
    trips = clean_trips(spark, sf_dir)
    pairs = match_return_trips(trips)
    for df in (pairs, match_adjacent_slots(trips), pairs.select("to_pickup_lon")):
        of_roles = [e for e in _exchanges(df) if "direct_shuffle_partition_id" in e.outputPartitioning().toString()]
        assert len(of_roles) == 2 and of_roles[0].sameResult(of_roles[1])


def test_few_rows_travel(spark, sf_dir):
    """Both roles together sent 4.1 rows for each trip."""
    base = _prepare(clean_trips(spark, sf_dir), YELLOW_CAB, False, False)
    rows = _wide_rows(base, CANONICAL_SPEC, 9, _wide_slots(CANONICAL_SPEC)).count()
    assert base.count() <= rows < 2 * base.count()


@pytest.mark.parametrize("name", ["return_trips", "return_trips_count", "return_trips_adjacent_uniform", "distance_gap_join_count"])
def test_generated_code_is_small_enough_to_be_compiled(spark, sf_dir, name):
    """The JVM compiles no method of over 8,000 bytes."""
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan()
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    df.collect()
    code = debug.codegenStringSeq(plan)
    sizes = [code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())]
    assert sizes and max(sizes) <= 8000


def test_within_is_the_distance(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(4000):
        lat, lon = rng.choice([40.7, 0.0, 78.0, 89.9995, -90.0, 95.0]) + rng.uniform(-1e-4, 1e-4), rng.choice([-74.0, 179.9999, -180.0, 10.0])
        far = 100 * rng.choice([1, 1 - 1e-9, 1 + 1e-9, 1 + 1e-5, rng.uniform(0, 3)]) / 6371e3 * 180 / math.pi
        turn = rng.uniform(0, 2 * math.pi)
        east = far * math.cos(turn) / max(1e-3, abs(math.cos(math.radians(lat))))
        lon2 = lon + east
        rows.append((lat, lon, lat + far * math.sin(turn), rng.choice([lon2, lon2 - 360 if lon2 > 180 else lon2 + 360])))
    rows += [(0.0, 0.0, 0.0, 0.0), (200.0, 1.0, 200.0, 1.0), (float("nan"), 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").withColumns({"ac": cos_lat(F.col("a")), "cc": cos_lat(F.col("c"))})
    for radius in (0.0, 100.0, 5e4, 5e6):
        exact = haversine_m(F.col("a"), F.col("c"), F.col("b"), F.col("d")) <= radius
        got = df.select(exact.alias("x"), within(radius, ("a", "b", "ac"), ("c", "d", "cc")).alias("y"))
        assert got.where(~F.col("x").eqNullSafe(F.col("y"))).count() == 0
        assert radius != 100.0 or got.where("x").count() > 500


def _odd_places(n):
    """Trips between places at the antimeridian, the poles and New York."""
    rng = random.Random(11)
    places = [(0.5, 179.9999), (0.5, -179.9999), (89.0, 20.0), (89.0002, 20.03), (89.9999, -100.0), (89.9999, 80.0), (-89.9995, 180.0), (75.0, -180.0), (75.0, 179.999), (40.7, -74.0)]
    rows = []
    for i in range(n):
        (a, b), (c, d) = rng.choice(places), rng.choice(places)
        start = rng.randrange(90_000)
        j = [rng.uniform(-3e-4, 3e-4) for _ in range(4)]
        rows.append((T0 + start, T0 + start + rng.randrange(-3000, 60_000), max(-180.0, min(180.0, b + j[0])), max(-90.0, min(90.0, a + j[1])), max(-180.0, min(180.0, d + j[2])), max(-90.0, min(90.0, c + j[3]))))
    return rows


NAMES = ["pickup_ts", "dropoff_ts", "pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat"]


def test_match_at_poles_and_antimeridian(spark):
    df = spark.createDataFrame(_odd_places(700), ", ".join(f"{n} {'long' if 'ts' in n else 'double'}" for n in NAMES))
    trips = df.toDF(*YELLOW_CAB.names())
    trips = trips.select(*[F.timestamp_seconds(c).alias(c) if "datetime" in c else F.col(c) for c in trips.columns])
    pdf = with_epoch_seconds(trip_table(trips)).toPandas()
    want = as_bag(all_pairs(pdf))
    assert len(want) > 50
    for layout in (Layout(), Layout(coarse=1, pairs=2)):
        assert as_bag(with_epoch_seconds(match_return_trips(trips, layout=layout))) == want


def test_distance_gap_join_at_poles_and_antimeridian(spark):
    df = spark.createDataFrame(_odd_places(500) + [(None, None, None, None, None, None), (T0, T0, None, 1.0, 2.0, None)], ", ".join(f"{n} {'long' if 'ts' in n else 'double'}" for n in NAMES))
    a, b = (df.select(*[F.col(c).alias(f"{r}_{c}") for c in df.columns]) for r in "ab")
    gap = F.col("b_pickup_ts") - F.col("a_dropoff_ts")
    near = haversine_m(F.col("b_pickup_lat"), F.col("a_dropoff_lat"), F.col("b_pickup_lon"), F.col("a_dropoff_lon")) <= 100.0
    want = as_bag(a.crossJoin(b).where((gap > 0) & (gap < 28800) & near))
    assert len(want) > 500
    points = ("a_dropoff_lat", "a_dropoff_lon"), ("b_pickup_lat", "b_pickup_lon")
    for pairs in (None, 5):
        assert as_bag(distance_gap_join(a, b, *points, "a_dropoff_ts", "b_pickup_ts", pairs=pairs)) == want
