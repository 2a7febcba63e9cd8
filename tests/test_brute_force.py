"""Grid matching against an all-pairs brute force on the sf0.001 trips."""

import pytest
from pyspark.sql import functions as F

from helpers import all_pairs, as_bag
from homeward.catalog import with_epoch_seconds
from homeward.operators import count_gap_pairs, distance_gap_join, distance_join, gap_join
from homeward.plans import match_adjacent_slots, match_return_trips, trip_table
from homeward.plans.return_trips import Layout
from homeward.sources import clean_trips, raw_trips


@pytest.fixture(scope="module")
def trips(spark, sf_dir):
    return clean_trips(spark, sf_dir)


@pytest.fixture(scope="module")
def table(trips):
    return with_epoch_seconds(trip_table(trips)).toPandas()


@pytest.fixture(scope="module")
def expected(table):
    return as_bag(all_pairs(table))


@pytest.mark.parametrize(
    "layout",
    [
        Layout(),
        Layout(pairs=8),
        Layout(pairs=1, coarse=3, partitions=5),
        Layout(coarse=1),
        Layout(coarse=40, pairs=500),
    ],
    ids=["default", "fine_and_parts", "all_split", "fine_only", "wide"],
)
def test_return_trips_equal_all_pairs(trips, expected, layout):
    got = as_bag(with_epoch_seconds(match_return_trips(trips, layout=layout)))
    assert len(got) == len(expected) == 123
    assert got == expected


def test_fixed_grid_equals_all_pairs_here(trips, expected):
    assert as_bag(with_epoch_seconds(match_return_trips(trips, neighbours="fixed"))) == expected


def test_adjacent_slots_twice_each(trips, table):
    pairs = all_pairs(table, adjacent_slot=28800).drop(columns=["to_pickup_s", "back_dropoff_s"])
    doubled = as_bag(pairs) + as_bag(pairs)
    got = as_bag(with_epoch_seconds(match_adjacent_slots(trips)))
    assert len(got) == 368
    assert got == sorted(doubled)


def test_gap_join_and_distance_join_counts(spark, table, trips):
    import numpy as np

    from helpers import hav

    t = trip_table(trips)
    a = t.select(*[F.col(c).alias("a_" + c) for c in t.columns])
    b = t.select(*[F.col(c).alias("b_" + c) for c in t.columns])
    d = table.dropoff_s.to_numpy()
    p = table.pickup_s.to_numpy()
    gap = p[None, :] - d[:, None]
    assert gap_join(a, b, "a_dropoff_ts", "b_pickup_ts", 28800).count() == int(((gap > 0) & (gap < 28800)).sum())
    for low, high in ((0, 28800), (0, 1), (0, 2), (100, 5000), (3000, 3001), (5000, 100), (-4000, 200), (10, 10**9), (-1, 1)):
        n = count_gap_pairs(a, b, "a_dropoff_ts", "b_pickup_ts", high, low).first()["n"]
        assert n == int(((gap > low) & (gap < high)).sum())
    assert gap_join(a, b, "a_dropoff_ts", "b_pickup_ts", 28800, width_s=5000).count() == int(
        ((gap > 0) & (gap < 28800)).sum()
    )
    dist = hav(
        table.pickup_lat.to_numpy()[None, :],
        table.dropoff_lat.to_numpy()[:, None],
        table.pickup_lon.to_numpy()[None, :],
        table.dropoff_lon.to_numpy()[:, None],
    )
    n = distance_join(a, b, ("a_dropoff_lat", "a_dropoff_lon"), ("b_pickup_lat", "b_pickup_lon"), 100.0).count()
    assert n == int((dist <= 100.0).sum())
    points = ("a_dropoff_lat", "a_dropoff_lon"), ("b_pickup_lat", "b_pickup_lon")
    n = distance_gap_join(a, b, *points, "a_dropoff_ts", "b_pickup_ts").count()
    assert n == int(((dist <= 100.0) & (gap > 0) & (gap < 28800)).sum())


def test_raw_variants(spark, sf_dir):
    raw = raw_trips(spark, sf_dir)
    assert match_return_trips(raw).count() == 201
    assert match_return_trips(raw, clean=True).count() == 123
    assert match_return_trips(raw, distinct=True).count() == 178


def test_candidate_count_equals_candidate_join(trips):
    from homeward.plans import MatchSpec, count_candidates, return_trip_candidates

    for spec in (MatchSpec(neighbours="fixed", slot_mode="none"), MatchSpec(neighbours="fixed", slot_mode="fixed"), MatchSpec()):
        assert count_candidates(trips, spec).first()["n"] == return_trip_candidates(trips, spec).count()
