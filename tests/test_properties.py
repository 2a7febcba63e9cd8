"""Properties of the match on generated trips, against the brute force.

Each property is checked on many generated cases at once: every case lies
in a region of its own, degrees away from the others, so one Spark job
matches them all and no pair crosses cases.
"""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import all_pairs, as_bag
from homeward.catalog import with_epoch_seconds
from homeward.plans import Layout, match_return_trips

T0 = 1451606400
HUBS = [(-73.9, 40.7), (-73.9008, 40.7005), (-73.95, 40.75), (-73.9495, 40.7504)]
CASES = 30
NAMES = ["pickup_s", "dropoff_s", "pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat"]


def _case(r: random.Random, region: int) -> list[tuple]:
    out = []
    for _ in range(r.randrange(2, 40)):
        pickup = T0 + r.randrange(3 * 86400)
        (alon, alat), (blon, blat) = r.choice(HUBS), r.choice(HUBS)
        jitter = r.randrange(-60, 61) * 1e-5
        east = 2.0 * region
        out.append((pickup, pickup + r.randrange(-120, 4000), alon + east + jitter, alat, blon + east, blat - jitter))
    return out


def _table(seed: int) -> list[list[tuple]]:
    r = random.Random(seed)
    return [_case(r, i) for i in range(CASES)]


def _frame(spark, rows, shift=0):
    data = [(a + shift, b + shift, *rest) for a, b, *rest in rows]
    df = spark.createDataFrame(
        data,
        "tpep_pickup_datetime long, tpep_dropoff_datetime long, pickup_longitude double, "
        "pickup_latitude double, dropoff_longitude double, dropoff_latitude double",
    )
    return df.withColumns({c: F.timestamp_seconds(c) for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")})


def _by_case(df) -> dict[int, int]:
    region = F.round((F.col("to_pickup_lon") + 73.9) / 2.0).cast("int")
    return {r.region: r["count"] for r in df.groupBy(region.alias("region")).count().collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    cases = _table(seed)
    want = [p for c in cases for p in as_bag(all_pairs(pd.DataFrame(c, columns=NAMES)))]
    df = _frame(spark, [t for c in cases for t in c])
    for layout in (Layout(), Layout(pairs=3)):
        assert as_bag(with_epoch_seconds(match_return_trips(df, layout=layout))) == sorted(want)


def test_monotone_in_radius_and_gap(spark):
    r = random.Random(3)
    df = _frame(spark, [t for c in _table(3) for t in c])
    radius, gap = float(r.randrange(50, 300)), r.randrange(5000, 40000)
    small = _by_case(match_return_trips(df, radius_m=radius, max_gap_s=gap))
    wider = _by_case(match_return_trips(df, radius_m=radius + 50.0, max_gap_s=gap))
    longer = _by_case(match_return_trips(df, radius_m=radius, max_gap_s=gap + 5000))
    assert len(small) >= 25
    assert all(n <= wider[c] and n <= longer[c] for c, n in small.items())


def test_time_shift_and_duplication(spark):
    rows = [t for c in _table(4) for t in c]
    df = _frame(spark, rows)
    n = _by_case(match_return_trips(df))
    assert len(n) >= 25
    assert _by_case(match_return_trips(_frame(spark, rows, shift=-1234567))) == n
    assert _by_case(match_return_trips(df.unionAll(df))) == {c: 4 * k for c, k in n.items()}
    once = _by_case(match_return_trips(df, distinct=True))
    assert _by_case(match_return_trips(df.unionAll(df), distinct=True)) == once
