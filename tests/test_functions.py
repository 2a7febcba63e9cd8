import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homeward.functions import METRIC, UNIFORM_176, CellKeys, SlotKeys, epoch_seconds, haversine_m, time_slot
from homeward.functions.grid import GRID_MAX_LAT_DEG


def test_haversine_known_distances(spark):
    df = spark.createDataFrame(
        [(0.0, 1.0, 0.0, 0.0), (40.7, 40.7, -74.0, -74.0), (0.0, 0.0, 0.0, 90.0)],
        "lat1 double, lat2 double, lon1 double, lon2 double",
    )
    got = [r[0] for r in df.select(haversine_m(F.col("lat1"), F.col("lat2"), F.col("lon1"), F.col("lon2"))).collect()]
    assert got[0] == pytest.approx(2 * math.pi * 6371e3 / 360, rel=1e-12)
    assert got[1] == 0.0
    assert got[2] == pytest.approx(2 * math.pi * 6371e3 / 4, rel=1e-12)


def test_epoch_seconds_timestamp_ntz_and_long(spark):
    df = spark.sql(
        "SELECT TIMESTAMP '2016-01-01 00:00:01' AS lt, TIMESTAMP_NTZ '2016-01-01 00:00:01' AS nt, 1451606401L AS e"
    )
    types = {f.name: f.dataType for f in df.schema.fields}
    row = df.select(*[epoch_seconds(F.col(c), types[c]).alias(c) for c in ("lt", "nt", "e")]).first()
    # the session runs in UTC; NTZ is read as UTC wall time in any zone
    assert row.lt == row.nt == row.e == 1451606401
    with pytest.raises(TypeError):
        epoch_seconds(F.col("x"), T.StringType())


def test_grid_constants():
    assert UNIFORM_176.lat_scale == 176.0 and UNIFORM_176.offset == 180.0
    assert METRIC.cell_height_m() == pytest.approx(101.0)
    assert METRIC.cell_width_m(GRID_MAX_LAT_DEG) == pytest.approx(101.0)
    assert METRIC.cell_width_m(40.7) == pytest.approx(157.4, abs=0.5)
    assert METRIC.fixed_limit_lat_deg(100.0) == pytest.approx(61.2, abs=0.1)


def test_cells_and_slots(spark):
    df = spark.createDataFrame([(40.7, -74.0, 1451606400)], "lat double, lon double, t long")
    r = df.select(
        METRIC.lat_cell(F.col("lat")).alias("a"),
        METRIC.lon_cell(F.col("lon")).alias("b"),
        UNIFORM_176.lat_cell(F.col("lat")).alias("c"),
        time_slot(F.col("t"), 29800).alias("d"),
    ).first()
    assert r.a == math.floor(40.7 * METRIC.lat_scale)
    assert r.b == math.floor(-74.0 * METRIC.lon_scale)
    assert r.c == math.floor((40.7 + 180) * 176)
    assert r.d == 1451606400 // 29800


def test_fixed_mode_rejects_small_cells():
    from homeward.functions.grid import metric_grid

    with pytest.raises(ValueError):
        CellKeys(metric_grid(50), 100.0, "fixed")
    CellKeys(metric_grid(50), 100.0, "reach")  # any cell size works


def test_slot_reach_covers_every_gap(spark):
    """For each late time, the reach slots are exactly the slots of the
    early times 1 .. max_gap-1 seconds before it."""
    sk = SlotKeys(width_s=1000, max_gap_s=2500, mode="reach")
    df = spark.range(0, 4000, 7).select(F.col("id").alias("t"))
    got = {r.t: set(r.s) for r in df.select("t", sk.reach(F.col("t")).alias("s")).collect()}
    for t, slots in got.items():
        want = {(t - g) // 1000 for g in range(1, 2500)}
        assert slots == want, t
