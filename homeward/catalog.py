"""Registered queries over the shared test tables.

Trips are derived from ``lineitem`` (``sources.testdata``); every query
reads the whole table.  Time columns are reported as whole epoch seconds
(``*_s``) so that results compare exactly with other engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.geo import epoch_seconds, haversine_m
from .functions.grid import METRIC, UNIFORM_176, CellKeys, SlotKeys
from .operators.clean import distinct_rows, nonzero_coordinates, positive_duration
from .operators.expand import neighbour_clones, time_clones, with_cells, with_time_slot
from .operators.distance_count import count_distance_pairs
from .operators.joins import count_gap_pairs, distance_gap_join
from .operators.summary import count_rows, first_rows
from .plans.return_trips import (
    Layout,
    MatchSpec,
    count_candidates,
    count_return_trips,
    match_adjacent_slots,
    match_return_trips,
    trip_table,
)
from .session import keep
from .sources.schema import TRIP_FIELDS
from .sources.testdata import clean_trips, corrupt_trips, raw_trips

SAMPLE_ROWS = 5000
FINE_LAYOUT = Layout(pairs=16)

_TIME_NAMES = {
    "tpep_pickup_datetime": "pickup_s",
    "tpep_dropoff_datetime": "dropoff_s",
}


def with_epoch_seconds(df: DataFrame) -> DataFrame:
    """Replace every timestamp column by whole epoch seconds; ``*_ts``
    becomes ``*_s``."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            name = _TIME_NAMES.get(f.name) or (f.name[:-3] + "_s" if f.name.endswith("_ts") else f.name)
            out.append(epoch_seconds(F.col(f.name), f.dataType).alias(name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_table(clean_trips(spark, sf_dir))


# ---- sources, filters, projections -------------------------------------


def q_trips_projection(spark, sf_dir):
    return with_epoch_seconds(_trips(spark, sf_dir))


def q_nonzero_coordinates(spark, sf_dir):
    return with_epoch_seconds(nonzero_coordinates(raw_trips(spark, sf_dir)))


def q_positive_duration(spark, sf_dir):
    return with_epoch_seconds(positive_duration(raw_trips(spark, sf_dir)))


def q_input_distinct(spark, sf_dir):
    return with_epoch_seconds(distinct_rows(raw_trips(spark, sf_dir)))


# ---- scalar functions ---------------------------------------------------


def q_haversine_pickup_dropoff(spark, sf_dir):
    t = _trips(spark, sf_dir)
    dist = haversine_m(F.col("pickup_lat"), F.col("dropoff_lat"), F.col("pickup_lon"), F.col("dropoff_lon"))
    return with_epoch_seconds(t.withColumn("dist_cm", F.floor(dist * 100)))


def q_lat_cell(spark, sf_dir):
    t = _trips(spark, sf_dir)
    t = t.withColumns(
        {
            "pickup_lat_cell": METRIC.lat_cell(F.col("pickup_lat")),
            "dropoff_lat_cell": METRIC.lat_cell(F.col("dropoff_lat")),
        }
    )
    return with_epoch_seconds(t)


def q_lon_cell(spark, sf_dir):
    t = _trips(spark, sf_dir)
    t = t.withColumns(
        {
            "pickup_lon_cell": METRIC.lon_cell(F.col("pickup_lon")),
            "dropoff_lon_cell": METRIC.lon_cell(F.col("dropoff_lon")),
        }
    )
    return with_epoch_seconds(t)


def q_uniform_cell(spark, sf_dir):
    t = _trips(spark, sf_dir)
    t = with_cells(t, UNIFORM_176, "pickup_lat", "pickup_lon", "pickup_lat_cell", "pickup_lon_cell")
    t = with_cells(t, UNIFORM_176, "dropoff_lat", "dropoff_lon", "dropoff_lat_cell", "dropoff_lon_cell")
    return with_epoch_seconds(t)


def _time_buckets(width):
    def q(spark, sf_dir):
        t = _trips(spark, sf_dir)
        t = with_time_slot(t, "pickup_ts", width, "pickup_slot")
        t = with_time_slot(t, "dropoff_ts", width, "dropoff_slot")
        return with_epoch_seconds(t)

    return q


# ---- generators ----------------------------------------------------------


def q_neighbour_cells(spark, sf_dir):
    """3 x 3 block of the pickup cell (classic clone)."""
    t = _trips(spark, sf_dir)
    t = neighbour_clones(t, CellKeys(METRIC, 100.0, "fixed"), "pickup_lat", "pickup_lon", "lat_key", "lon_key")
    return with_epoch_seconds(t)


def q_reach_cells(spark, sf_dir):
    """Only the cells the 100 m disc of the pickup touches."""
    t = _trips(spark, sf_dir)
    t = neighbour_clones(t, CellKeys(METRIC, 100.0, "reach"), "pickup_lat", "pickup_lon", "lat_key", "lon_key")
    return with_epoch_seconds(t)


def q_time_clones(spark, sf_dir):
    """Pickup slot and the slot before (29800 s slots)."""
    t = _trips(spark, sf_dir)
    t = time_clones(t, SlotKeys(29800, 28800, 0, "fixed"), "pickup_ts", "slot_key")
    return with_epoch_seconds(t)


def q_reach_time_clones(spark, sf_dir):
    """Only the slots a dropoff 1 to 28799 s earlier can lie in."""
    t = _trips(spark, sf_dir)
    t = time_clones(t, SlotKeys(29800, 28800, 0, "reach"), "pickup_ts", "slot_key")
    return with_epoch_seconds(t)


def q_time_clones_both_sides(spark, sf_dir):
    """Script style: 8 h slots of pickup and dropoff, the pickup slot cloned
    into itself and the slot before (both join sides carry these)."""
    t = _trips(spark, sf_dir)
    t = with_time_slot(t, "dropoff_ts", 28800, "dropoff_slot")
    t = time_clones(t, SlotKeys(28800, None, 0, "adjacent"), "pickup_ts", "pickup_slot")
    return with_epoch_seconds(t)


# ---- joins ----------------------------------------------------------------


def q_spatial_bucket_join_count(spark, sf_dir):
    """Candidates of the classic space-only bucket join (3 x 3 blocks)."""
    spec = MatchSpec(neighbours="fixed", slot_mode="none")
    return count_candidates(clean_trips(spark, sf_dir), spec)


def q_spacetime_bucket_join_count(spark, sf_dir):
    """Candidates of the classic space and time bucket join."""
    spec = MatchSpec(neighbours="fixed", slot_mode="fixed")
    return count_candidates(clean_trips(spark, sf_dir), spec)


def _roles(spark, sf_dir):
    t = _trips(spark, sf_dir)
    a = t.select(*[F.col(c).alias(f"a_{c}") for c in t.columns])
    b = t.select(*[F.col(c).alias(f"b_{c}") for c in t.columns])
    return a, b


def q_gap_join_count(spark, sf_dir):
    a, b = _roles(spark, sf_dir)
    return count_gap_pairs(a, b, "a_dropoff_ts", "b_pickup_ts", max_gap_s=28800)


def q_distance_join_count(spark, sf_dir):
    a, b = _roles(spark, sf_dir)
    found = count_distance_pairs(a, b, ("a_dropoff_lat", "a_dropoff_lon"), ("b_pickup_lat", "b_pickup_lon"), 100.0)
    return found.select("n")


def q_distance_gap_join_count(spark, sf_dir):
    """Dropoffs and later pickups within 100 m and 8 h."""
    a, b = _roles(spark, sf_dir)
    points = ("a_dropoff_lat", "a_dropoff_lon"), ("b_pickup_lat", "b_pickup_lon")
    times = "a_dropoff_ts", "b_pickup_ts"
    # a count needs no other columns
    sides = [t.select(*point, ts) for t, point, ts in zip((a, b), points, times)]
    return count_rows(distance_gap_join(*sides, *points, *times))


# ---- whole queries ------------------------------------------------------


def q_return_trips(spark, sf_dir):
    return with_epoch_seconds(match_return_trips(clean_trips(spark, sf_dir)))


def q_return_trips_two_level(spark, sf_dir):
    """The canonical match with splitting forced: fine keys of more than a
    few candidates go to parts, as many as even out the partitions."""
    return with_epoch_seconds(match_return_trips(clean_trips(spark, sf_dir), layout=FINE_LAYOUT))


def q_return_trips_fixed_grid(spark, sf_dir):
    return with_epoch_seconds(match_return_trips(clean_trips(spark, sf_dir), neighbours="fixed"))


def q_return_trips_clean(spark, sf_dir):
    return with_epoch_seconds(match_return_trips(raw_trips(spark, sf_dir), clean=True))


def q_return_trips_distinct(spark, sf_dir):
    return with_epoch_seconds(match_return_trips(raw_trips(spark, sf_dir), distinct=True))


def q_return_trips_adjacent_slots(spark, sf_dir):
    return with_epoch_seconds(match_adjacent_slots(clean_trips(spark, sf_dir)))


def q_return_trips_bad_coordinates(spark, sf_dir):
    """The canonical match of trips among which some have no, infinite,
    huge, undefined or out-of-range coordinates."""
    return with_epoch_seconds(match_return_trips(corrupt_trips(spark, sf_dir)))


def q_return_trips_adjacent_uniform(spark, sf_dir):
    """The script variant on its own uniform grid and 3 x 3 blocks."""
    return with_epoch_seconds(match_adjacent_slots(clean_trips(spark, sf_dir), grid=UNIFORM_176, neighbours="fixed"))


def q_return_trips_limited(spark, sf_dir):
    sample = first_rows(nonzero_coordinates(raw_trips(spark, sf_dir)), SAMPLE_ROWS, order=TRIP_FIELDS)
    # the match reads its input several times, the table is read once
    return with_epoch_seconds(match_adjacent_slots(keep(sample, "sample")))


def q_return_trips_count(spark, sf_dir):
    return count_return_trips(raw_trips(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "trips_projection": q_trips_projection,
    "nonzero_coordinates": q_nonzero_coordinates,
    "positive_duration": q_positive_duration,
    "input_distinct": q_input_distinct,
    "haversine_pickup_dropoff": q_haversine_pickup_dropoff,
    "lat_cell": q_lat_cell,
    "lon_cell": q_lon_cell,
    "uniform_cell": q_uniform_cell,
    "time_bucket_29800": _time_buckets(29800),
    "time_bucket_28800": _time_buckets(28800),
    "neighbour_cells": q_neighbour_cells,
    "reach_cells": q_reach_cells,
    "time_clones": q_time_clones,
    "reach_time_clones": q_reach_time_clones,
    "time_clones_both_sides": q_time_clones_both_sides,
    "spatial_bucket_join_count": q_spatial_bucket_join_count,
    "spacetime_bucket_join_count": q_spacetime_bucket_join_count,
    "gap_join_count": q_gap_join_count,
    "distance_join_count": q_distance_join_count,
    "distance_gap_join_count": q_distance_gap_join_count,
    "return_trips": q_return_trips,
    "return_trips_two_level": q_return_trips_two_level,
    "return_trips_fixed_grid": q_return_trips_fixed_grid,
    "return_trips_clean": q_return_trips_clean,
    "return_trips_distinct": q_return_trips_distinct,
    "return_trips_adjacent_slots": q_return_trips_adjacent_slots,
    "return_trips_adjacent_uniform": q_return_trips_adjacent_uniform,
    "return_trips_bad_coordinates": q_return_trips_bad_coordinates,
    "return_trips_limited": q_return_trips_limited,
    "return_trips_count": q_return_trips_count,
}
