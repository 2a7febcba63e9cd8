"""Edge tables: open gap bounds, multiplicities, self match, grid limits."""

import pytest
from pyspark.sql import functions as F

from homeward.plans import match_return_trips
from homeward.plans.return_trips import Layout

T0 = 1451606400
P = (-73.9, 40.7)  # (lon, lat)
Q = (-73.95, 40.75)
SCHEMA = (
    "tpep_pickup_datetime long, tpep_dropoff_datetime long, pickup_longitude double, "
    "pickup_latitude double, dropoff_longitude double, dropoff_latitude double"
)


def trips(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns(
        {
            "tpep_pickup_datetime": F.timestamp_seconds("tpep_pickup_datetime"),
            "tpep_dropoff_datetime": F.timestamp_seconds("tpep_dropoff_datetime"),
        }
    )


def trip(t_pick, t_drop, a, b):
    return (T0 + t_pick, T0 + t_drop, a[0], a[1], b[0], b[1])


def a_then_b(b_pickup):
    return [trip(0, 100, P, Q), trip(b_pickup, b_pickup + 300, Q, P)]


def lat78():
    rows = []
    for lon in (10.0, 20.00001, 30.0017):
        far = lon + 0.004282  # 99 m east at 78 degrees
        rows += [trip(0, 100, (lon, 78.0), (far, 78.0)), trip(1000, 1100, (lon, 78.0), (far, 78.0))]
    return rows


ANTIMERIDIAN = [
    trip(0, 100, (179.9999, 0.5), (-179.9999, 0.5)),
    trip(1000, 1100, (179.9999, 0.5), (-179.9999, 0.5)),
]

CASES = {
    # name: (rows, fixed grid, distinct with fixed grid, all pairs)
    "gap 0": (a_then_b(100), 0, 0, 0),
    "gap 1 s": (a_then_b(101), 1, 1, 1),
    "gap 28799 s": (a_then_b(28899), 1, 1, 1),
    "gap 28800 s": (a_then_b(28900), 0, 0, 0),
    "duplicates": ([trip(0, 100, P, Q)] * 2 + [trip(200, 500, Q, P)] * 3, 6, 1, 6),
    "self match": ([trip(600, 0, P, P)], 1, 1, 1),
    "latitude 78": (lat78(), 0, 0, 3),
    "antimeridian": (ANTIMERIDIAN, 0, 0, 1),
}


@pytest.mark.parametrize("name", list(CASES))
def test_edge_cases(spark, name):
    rows, fixed, fixed_distinct, all_pairs = CASES[name]
    df = trips(spark, rows)
    assert match_return_trips(df, neighbours="fixed").count() == fixed
    assert match_return_trips(df, neighbours="fixed", distinct=True).count() == fixed_distinct
    assert match_return_trips(df, layout=Layout(pairs=1)).count() == all_pairs
    assert match_return_trips(df, layout=Layout(coarse=1)).count() == all_pairs


def test_null_and_nan_rows_never_match(spark):
    rows = a_then_b(1000) + [(T0, T0 + 100, None, 40.7, -73.95, 40.75), (None, T0 + 1300, -73.95, 40.75, -73.9, 40.7)]
    df = trips(spark, rows)
    df = df.union(trips(spark, [trip(1000, 1300, Q, (float("nan"), 40.7))]))
    assert match_return_trips(df).count() == 1


def test_timestamp_ntz_input(spark):
    df = trips(spark, a_then_b(1000))
    ntz = df.select(
        *[F.col(c).cast("timestamp_ntz").alias(c) if "datetime" in c else F.col(c) for c in df.columns]
    )
    out = match_return_trips(ntz)
    assert out.count() == 1
    assert dict(out.dtypes)["to_pickup_ts"] == "timestamp_ntz"


def test_result_does_not_depend_on_layout_or_grid(spark):
    from homeward.functions.grid import metric_grid

    rows = a_then_b(101) + lat78() + ANTIMERIDIAN + [trip(0, 100, P, Q)] * 2 + [trip(200, 500, Q, P)] * 3
    df = trips(spark, rows)
    base = sorted(match_return_trips(df).collect())
    for kw in (
        dict(grid=metric_grid(40.0)),
        dict(grid=metric_grid(400.0)),
        dict(slot_width_s=3600),
        dict(layout=Layout(pairs=1)),
        dict(layout=Layout(pairs=2, coarse=7)),
        dict(layout=Layout(coarse=1)),
        dict(layout=Layout(partitions=3)),
    ):
        assert sorted(match_return_trips(df, **kw).collect()) == base, kw


def test_large_radius_and_gap_scale_the_grid(spark):
    """Same answer as the brute force for a 5 km radius and a 2 day gap."""
    from helpers import all_pairs, as_bag
    from homeward.catalog import with_epoch_seconds

    rows = [trip(i * 3600, i * 3600 + 600, (-73.9 + 0.01 * (i % 5), 40.7), (-73.95, 40.75 + 0.01 * (i % 3))) for i in range(40)]
    rows += [trip(i * 5000, i * 5000 + 900, (-73.95, 40.75 + 0.01 * (i % 4)), (-73.9 + 0.01 * (i % 6), 40.7)) for i in range(40)]
    df = trips(spark, rows)
    got = as_bag(with_epoch_seconds(match_return_trips(df, radius_m=5000.0, max_gap_s=172800)))
    pdf = with_epoch_seconds(
        df.selectExpr(
            "tpep_pickup_datetime AS pickup_ts", "tpep_dropoff_datetime AS dropoff_ts",
            "pickup_longitude AS pickup_lon", "pickup_latitude AS pickup_lat",
            "dropoff_longitude AS dropoff_lon", "dropoff_latitude AS dropoff_lat",
        )
    ).toPandas()
    want = as_bag(all_pairs(pdf, radius=5000.0, max_gap=172800))
    assert len(want) > 0 and got == want
