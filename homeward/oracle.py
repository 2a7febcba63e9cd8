"""Oracle SQL (DuckDB dialect) for the registered queries.

Each statement recomputes its answer from the ``lineitem`` view alone,
with its own bucketing (8 h slots, 0.002 degree latitude bands) where a
match is needed, so that it cannot share a bucketing error with the
engine.  Double literals are written in exponent form (DuckDB reads
``0.0015`` as DECIMAL).
"""

from __future__ import annotations

# 101 m cells per degree of latitude, and of longitude at the
# grid's latitude limit; degrees that 100 m and a ten-thousandth span; cells
# per degree of the uniform grid.
K_LAT = "1100.9398677679083e0"
K_LON = "535.278989513407e0"
REACH_DEG = "8.994115380793224e-4"
U = "176e0"

BASE = """
parts AS (
    SELECT l_orderkey AS k, l_linenumber AS n, l_partkey, l_suppkey,
           l_quantity, l_discount, l_tax,
           l_partkey % 100 AS ph,
           (l_suppkey * 7 + l_linenumber * 13) % 100 AS dh,
           (l_orderkey * 7919 + l_linenumber * 104729) % 2592000 + 1451606400 AS ps
    FROM lineitem
),
geo AS (
    SELECT *,
           ps + 120 + (l_partkey * 31 + n) % 3000 AS ds,
           -74e0 + (ph % 10) * 15e-4 + ((k * 3) % 101 - 50) * 1e-5 AS plon,
           407e-1 + (ph // 10) * 11e-4 + ((k * 5) % 89 - 44) * 1e-5 AS plat,
           -74e0 + (dh % 10) * 15e-4 + ((k * 7) % 101 - 50) * 1e-5 AS dlon,
           407e-1 + (dh // 10) * 11e-4 + ((k * 11) % 89 - 44) * 1e-5 AS dlat
    FROM parts
),
trips AS (
    SELECT ps AS pickup_s, ds AS dropoff_s, plon AS pickup_lon, plat AS pickup_lat,
           dlon AS dropoff_lon, dlat AS dropoff_lat
    FROM geo
),
raw0 AS (
    SELECT CAST(1 + n % 2 AS VARCHAR) AS VendorID,
           ps AS pickup_s,
           CASE WHEN k % 89 = 0 THEN ps - 60 ELSE ds END AS dropoff_s,
           n AS passenger_count,
           l_quantity AS trip_distance,
           CASE WHEN k % 97 = 0 THEN 0e0 ELSE plon END AS pickup_longitude,
           CASE WHEN k % 97 = 0 THEN 0e0 ELSE plat END AS pickup_latitude,
           1 AS RatecodeID,
           'N' AS store_and_fwd_flag,
           CASE WHEN k % 89 = 0 THEN plon ELSE dlon END AS dropoff_longitude,
           CASE WHEN k % 89 = 0 THEN plat ELSE dlat END AS dropoff_latitude,
           CAST(1 + l_suppkey % 4 AS INTEGER) AS payment_type,
           l_quantity AS fare_amount,
           l_discount AS extra,
           l_tax AS mta_tax,
           0e0 AS tip_amount,
           0e0 AS tolls_amount,
           3e-1 AS improvement_surcharge,
           l_quantity AS total_amount,
           k
    FROM geo
),
raw AS (
    SELECT * EXCLUDE (k) FROM raw0
    UNION ALL
    SELECT * EXCLUDE (k) FROM raw0 WHERE k % 50 = 0
    UNION ALL
    SELECT * EXCLUDE (k) REPLACE (fare_amount + 1 AS fare_amount) FROM raw0 WHERE k % 50 = 1
)"""

RAW_ORDER = (
    "VendorID, pickup_s, dropoff_s, passenger_count, trip_distance, pickup_longitude, "
    "pickup_latitude, RatecodeID, store_and_fwd_flag, dropoff_longitude, dropoff_latitude, "
    "payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, "
    "improvement_surcharge, total_amount"
)
NONZERO = "pickup_longitude <> 0 AND pickup_latitude <> 0 AND dropoff_longitude <> 0 AND dropoff_latitude <> 0"


def _six(src: str) -> str:
    return (
        f"SELECT pickup_s, dropoff_s, pickup_longitude AS pickup_lon, pickup_latitude AS pickup_lat, "
        f"dropoff_longitude AS dropoff_lon, dropoff_latitude AS dropoff_lat FROM {src}"
    )


def hav(lat1: str, lat2: str, lon1: str, lon2: str) -> str:
    return (
        f"(2 * asin(sqrt(pow(sin(radians({lat1} - {lat2}) / 2), 2) + "
        f"pow(sin(radians({lon1} - {lon2}) / 2), 2) * cos(radians({lat1})) * cos(radians({lat2})))) * 6371e3)"
    )


PAIR_SELECT = ", ".join(
    [f"a.{c} AS to_{c}" for c in ("pickup_s", "dropoff_s", "pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat")]
    + [f"b.{c} AS back_{c}" for c in ("pickup_s", "dropoff_s", "pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat")]
)
ADJ_SELECT = ", ".join(
    [f"a.{c} AS to_{c}" for c in ("dropoff_s", "pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat")]
    + [f"b.{c} AS back_{c}" for c in ("pickup_s", "pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat")]
)


def _pairs(src_cte: str, adjacent: bool = False, select: str = PAIR_SELECT) -> str:
    """Pairs over the six-column CTE ``src_cte``: 8 h slots (the pickup of b
    in the dropoff slot of a or the next) and 0.002 degree latitude bands."""
    time_cond = "a.dropoff_s < b.pickup_s" + ("" if adjacent else " AND b.pickup_s < a.dropoff_s + 28800")
    return f"""
oa AS (
    SELECT *, dropoff_s // 28800 AS slot, CAST(floor(dropoff_lat * 500) AS BIGINT) AS band
    FROM {src_cte}
),
ob AS (
    SELECT s.*, s.pickup_s // 28800 + o.dt AS slot, CAST(floor(s.pickup_lat * 500) AS BIGINT) + p.db AS band
    FROM {src_cte} s CROSS JOIN (VALUES (-1), (0)) o(dt) CROSS JOIN (VALUES (-1), (0), (1)) p(db)
),
pairs AS (
    SELECT {select}
    FROM oa a JOIN ob b ON a.slot = b.slot AND a.band = b.band
    WHERE {time_cond}
      AND {hav('b.pickup_lat', 'a.dropoff_lat', 'b.pickup_lon', 'a.dropoff_lon')} <= 100
      AND {hav('a.pickup_lat', 'b.dropoff_lat', 'a.pickup_lon', 'b.dropoff_lon')} <= 100
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes)


def _candidate_count(with_time: bool) -> str:
    slot_a = ", CAST(floor(dropoff_s / 29800) AS BIGINT) AS t" if with_time else ""
    slot_b = ", CAST(floor(pickup_s / 29800) AS BIGINT) AS t" if with_time else ""
    group_t = ", t" if with_time else ""
    t_off = "CROSS JOIN (VALUES (0), (1)) o5(e)" if with_time else ""
    t_cond = "AND b.t = e.k5" if with_time else ""
    t_key = ", a.t + o5.e AS k5" if with_time else ""
    return _with(
        BASE,
        f"""ca AS (
    SELECT CAST(floor(pickup_lat * {K_LAT}) AS BIGINT) AS pla, CAST(floor(pickup_lon * {K_LON}) AS BIGINT) AS plo,
           CAST(floor(dropoff_lat * {K_LAT}) AS BIGINT) AS dla, CAST(floor(dropoff_lon * {K_LON}) AS BIGINT) AS dlo{slot_a}
    FROM trips
)""",
        f"""cb AS (
    SELECT CAST(floor(pickup_lat * {K_LAT}) AS BIGINT) AS pla, CAST(floor(pickup_lon * {K_LON}) AS BIGINT) AS plo,
           CAST(floor(dropoff_lat * {K_LAT}) AS BIGINT) AS dla, CAST(floor(dropoff_lon * {K_LON}) AS BIGINT) AS dlo{slot_b}
    FROM trips
)""",
        f"ga AS (SELECT pla, plo, dla, dlo{group_t}, count(*) AS na FROM ca GROUP BY ALL)",
        f"gb AS (SELECT pla, plo, dla, dlo{group_t}, count(*) AS nb FROM cb GROUP BY ALL)",
        f"""ea AS (
    SELECT a.pla + o1.x AS k1, a.plo + o2.y AS k2, a.dla + o3.u AS k3, a.dlo + o4.v AS k4{t_key}, a.na
    FROM ga a
    CROSS JOIN (VALUES (-1), (0), (1)) o1(x) CROSS JOIN (VALUES (-1), (0), (1)) o2(y)
    CROSS JOIN (VALUES (-1), (0), (1)) o3(u) CROSS JOIN (VALUES (-1), (0), (1)) o4(v) {t_off}
)""",
    ) + f"""
SELECT CAST(coalesce(sum(e.na * b.nb), 0) AS BIGINT) AS n
FROM ea e JOIN gb b ON b.dla = e.k1 AND b.dlo = e.k2 AND b.pla = e.k3 AND b.plo = e.k4 {t_cond}"""


def _cells(exprs: dict[str, str]) -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in exprs.items())
    return _with(BASE) + f"\nSELECT *, {cols} FROM trips"


def _slots(width: int) -> str:
    return _cells(
        {
            "pickup_slot": f"CAST(floor(pickup_s / {width}) AS BIGINT)",
            "dropoff_slot": f"CAST(floor(dropoff_s / {width}) AS BIGINT)",
        }
    )


def _cell(expr: str, scale: str, offset: str | None = None) -> str:
    inner = f"({expr} + {offset})" if offset else expr
    return f"CAST(floor({inner} * {scale}) AS BIGINT)"


ORACLE_SQL: dict[str, str] = {
    "trips_projection": _with(BASE) + "\nSELECT * FROM trips",
    "nonzero_coordinates": _with(BASE) + f"\nSELECT * FROM raw WHERE {NONZERO}",
    "positive_duration": _with(BASE) + "\nSELECT * FROM raw WHERE dropoff_s > pickup_s",
    "input_distinct": _with(BASE) + "\nSELECT DISTINCT * FROM raw",
    "haversine_pickup_dropoff": _cells(
        {"dist_cm": f"CAST(floor({hav('pickup_lat', 'dropoff_lat', 'pickup_lon', 'dropoff_lon')} * 100) AS BIGINT)"}
    ),
    "lat_cell": _cells(
        {"pickup_lat_cell": _cell("pickup_lat", K_LAT), "dropoff_lat_cell": _cell("dropoff_lat", K_LAT)}
    ),
    "lon_cell": _cells(
        {"pickup_lon_cell": _cell("pickup_lon", K_LON), "dropoff_lon_cell": _cell("dropoff_lon", K_LON)}
    ),
    "uniform_cell": _cells(
        {
            "pickup_lat_cell": _cell("pickup_lat", U, "180"),
            "pickup_lon_cell": _cell("pickup_lon", U, "180"),
            "dropoff_lat_cell": _cell("dropoff_lat", U, "180"),
            "dropoff_lon_cell": _cell("dropoff_lon", U, "180"),
        }
    ),
    "time_bucket_29800": _slots(29800),
    "time_bucket_28800": _slots(28800),
    "neighbour_cells": _with(BASE)
    + f"""
SELECT t.*, {_cell('pickup_lat', K_LAT)} + o1.x AS lat_key, {_cell('pickup_lon', K_LON)} + o2.y AS lon_key
FROM trips t CROSS JOIN (VALUES (-1), (0), (1)) o1(x) CROSS JOIN (VALUES (-1), (0), (1)) o2(y)""",
    "reach_cells": _with(
        BASE,
        f"""r AS (
    SELECT t.*, least({REACH_DEG} / cos(radians(least(abs(pickup_lat) + {REACH_DEG}, 89e0 + 2 * {REACH_DEG}))), 180e0) AS dlon
    FROM trips t
)""",
        f"""la AS (
    SELECT r.*, unnest(generate_series({_cell(f'(pickup_lat - {REACH_DEG})', K_LAT)},
                                       {_cell(f'(pickup_lat + {REACH_DEG})', K_LAT)})) AS lat_key
    FROM r
)""",
    )
    + f"""
SELECT pickup_s, dropoff_s, pickup_lon, pickup_lat, dropoff_lon, dropoff_lat, lat_key,
       unnest(generate_series({_cell('(pickup_lon - dlon)', K_LON)}, {_cell('(pickup_lon + dlon)', K_LON)})) AS lon_key
FROM la""",
    "time_clones": _with(BASE)
    + """
SELECT t.*, CAST(floor(pickup_s / 29800) AS BIGINT) + o.x AS slot_key
FROM trips t CROSS JOIN (VALUES (-1), (0)) o(x)""",
    "reach_time_clones": _with(BASE)
    + """
SELECT t.*, unnest(generate_series(CAST(floor((pickup_s - 28799) / 29800) AS BIGINT),
                                   CAST(floor((pickup_s - 1) / 29800) AS BIGINT))) AS slot_key
FROM trips t""",
    "time_clones_both_sides": _with(BASE)
    + """
SELECT t.*, CAST(floor(dropoff_s / 28800) AS BIGINT) AS dropoff_slot,
       CAST(floor(pickup_s / 28800) AS BIGINT) + o.x AS pickup_slot
FROM trips t CROSS JOIN (VALUES (-1), (0)) o(x)""",
    "spatial_bucket_join_count": _candidate_count(with_time=False),
    "spacetime_bucket_join_count": _candidate_count(with_time=True),
    "gap_join_count": _with(BASE)
    + """
SELECT count(*) AS n
FROM trips a JOIN trips b ON b.pickup_s > a.dropoff_s AND b.pickup_s < a.dropoff_s + 28800""",
    "distance_join_count": _with(
        BASE,
        """ca AS (
    SELECT dropoff_lat, dropoff_lon, CAST(floor(dropoff_lat * 1000) AS BIGINT) AS cy,
           CAST(floor(dropoff_lon * 700) AS BIGINT) AS cx
    FROM trips
)""",
        """cb AS (
    SELECT pickup_lat, pickup_lon, CAST(floor(pickup_lat * 1000) AS BIGINT) + o1.y AS cy,
           CAST(floor(pickup_lon * 700) AS BIGINT) + o2.x AS cx
    FROM trips CROSS JOIN (VALUES (-1), (0), (1)) o1(y) CROSS JOIN (VALUES (-1), (0), (1)) o2(x)
)""",
    )
    + f"""
SELECT count(*) AS n FROM ca a JOIN cb b ON a.cy = b.cy AND a.cx = b.cx
WHERE {hav('b.pickup_lat', 'a.dropoff_lat', 'b.pickup_lon', 'a.dropoff_lon')} <= 100""",
    "distance_gap_join_count": _with(
        BASE,
        """ca AS (
    SELECT dropoff_s, dropoff_lat, dropoff_lon, CAST(floor(dropoff_lat * 1000) AS BIGINT) AS cy,
           CAST(floor(dropoff_lon * 700) AS BIGINT) AS cx, dropoff_s // 28800 AS slot
    FROM trips
)""",
        """cb AS (
    SELECT pickup_s, pickup_lat, pickup_lon, CAST(floor(pickup_lat * 1000) AS BIGINT) + o1.y AS cy,
           CAST(floor(pickup_lon * 700) AS BIGINT) + o2.x AS cx, pickup_s // 28800 + o3.t AS slot
    FROM trips CROSS JOIN (VALUES (-1), (0), (1)) o1(y) CROSS JOIN (VALUES (-1), (0), (1)) o2(x) CROSS JOIN (VALUES (-1), (0)) o3(t)
)""",
    )
    + f"""
SELECT count(*) AS n FROM ca a JOIN cb b ON a.cy = b.cy AND a.cx = b.cx AND a.slot = b.slot
WHERE a.dropoff_s < b.pickup_s AND b.pickup_s < a.dropoff_s + 28800
  AND {hav('b.pickup_lat', 'a.dropoff_lat', 'b.pickup_lon', 'a.dropoff_lon')} <= 100""",
    # a trip with a corrupt pickup has no partner: none drops off there
    "return_trips_bad_coordinates": _with(BASE, _pairs("trips")) + "\nSELECT * FROM pairs",
    "return_trips_adjacent_uniform": _with(BASE, _pairs("trips", adjacent=True, select=ADJ_SELECT))
    + "\nSELECT p.* FROM pairs p CROSS JOIN (VALUES (0), (1)) twice(c)",
    "return_trips": _with(BASE, _pairs("trips")) + "\nSELECT * FROM pairs",
    "return_trips_two_level": _with(BASE, _pairs("trips")) + "\nSELECT * FROM pairs",
    "return_trips_fixed_grid": _with(BASE, _pairs("trips")) + "\nSELECT * FROM pairs",
    "return_trips_clean": _with(
        BASE,
        "src AS (" + _six("(SELECT DISTINCT * FROM raw) d WHERE dropoff_s > pickup_s") + ")",
        _pairs("src"),
    )
    + "\nSELECT * FROM pairs",
    "return_trips_distinct": _with(BASE, "src AS (" + _six("raw") + ")", _pairs("src"))
    + "\nSELECT DISTINCT * FROM pairs",
    "return_trips_adjacent_slots": _with(BASE, _pairs("trips", adjacent=True, select=ADJ_SELECT))
    + "\nSELECT p.* FROM pairs p CROSS JOIN (VALUES (0), (1)) twice(c)",
    "return_trips_limited": _with(
        BASE,
        "sample AS (SELECT * FROM raw WHERE " + NONZERO + " ORDER BY " + RAW_ORDER + " LIMIT 5000)",
        "src AS (" + _six("sample") + ")",
        _pairs("src", adjacent=True, select=ADJ_SELECT),
    )
    + "\nSELECT p.* FROM pairs p CROSS JOIN (VALUES (0), (1)) twice(c)",
    "return_trips_count": _with(BASE, "src AS (" + _six(f"raw WHERE {NONZERO}") + ")", _pairs("src"))
    + "\nSELECT count(*) AS n FROM pairs",
}
