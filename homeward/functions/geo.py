"""Scalar geo and time expressions, written as native Column expressions
(JVM side, whole-stage codegen; no Python UDF)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: mean earth radius in metres of the spherical earth model.
EARTH_RADIUS_M = 6371e3


def haversine_m(lat1: Column, lat2: Column, lon1: Column, lon2: Column) -> Column:
    """Great-circle distance in metres between (lat1, lon1) and (lat2, lon2).

    Arguments in degrees; order is lat, lat, lon, lon.  A result that
    rounds to NaN (argument of ``asin`` above 1) compares false with any
    limit, so such a pair never matches.
    """
    half_dlat = F.radians(lat1 - lat2) / 2
    half_dlon = F.radians(lon1 - lon2) / 2
    a = F.pow(F.sin(half_dlat), 2) + F.pow(F.sin(half_dlon), 2) * F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    )
    return F.lit(2) * F.asin(F.sqrt(a)) * F.lit(EARTH_RADIUS_M)


# Longest radius and largest difference in longitude up to which a flat
# distance bounds the great-circle distance to FLAT_MARGIN; and how near the
# radius the exact distance decides.
FLAT_RADIUS_M, FLAT_LON_DEG = 100e3, 1.0
NEAR_MARGIN, FLAT_MARGIN = 1e-6, 1e-4


def cos_lat(lat: Column) -> Column:
    """Cosine of a latitude for ``within``; NaN where it is none (never null)."""
    return F.coalesce(F.when(F.abs(lat) <= 90, F.cos(F.radians(lat))), F.lit(float("nan")))


def within(radius_m: float, one: tuple, two: tuple) -> Column:
    """Whether two points (latitude, longitude, ``cos_lat``: names or columns) are at most
    ``radius_m`` apart by ``haversine_m``, mostly without trigonometry.

    With x = half a difference in radians, sin(x)^2 <= x^2, so a flat distance
    below the radius (by more than rounding) proves it; for small x, sin(x)^2
    >= x^2 (1 - x^2 / 3), so one clearly above disproves it.  The rest, and
    latitudes out of range, are decided by ``haversine_m``."""
    (lat1, lon1, cos1), (lat2, lon2, cos2) = ([F.col(c) if isinstance(c, str) else c for c in p] for p in (one, two))
    exact = haversine_m(lat1, lat2, lon1, lon2) <= radius_m
    if not 0 <= radius_m <= FLAT_RADIUS_M:
        return exact
    limit = (math.sin(radius_m / (2 * EARTH_RADIUS_M)) * 360 / math.pi) ** 2
    dlat, dlon = lat1 - lat2, lon1 - lon2
    flat = dlat * dlat + dlon * dlon * (cos1 * cos2)
    undecided = (flat <= limit * (1 + FLAT_MARGIN)) | (F.abs(dlon) > FLAT_LON_DEG) | F.isnan(flat)
    return (flat <= limit * (1 - NEAR_MARGIN)) | (undecided & exact)


def epoch_seconds(col: Column, data_type: T.DataType) -> Column:
    """Whole epoch seconds of a time column, independent of the session zone.

    ``TIMESTAMP`` is cast to long (floor to the second); ``TIMESTAMP_NTZ``
    cannot be cast and is read as UTC wall time; integral columns are
    taken as epoch seconds already.
    """
    if isinstance(data_type, T.TimestampType):
        return col.cast("long")
    if isinstance(data_type, T.TimestampNTZType):
        return F.unix_timestamp(col)
    if isinstance(data_type, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return col.cast("long")
    raise TypeError(f"not a time column type: {data_type.simpleString()}")
