"""How the work is cut: dense keys, rows that cannot match, partitions,
sessions."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import as_bag
from homeward.catalog import QUERIES, with_epoch_seconds
from homeward.operators import balanced_join, first_rows, gap_join, heavy_keys
from homeward.plans import Layout, join_partitions, match_adjacent_slots, match_return_trips, matchable, return_trip_candidates, trip_table
from homeward.functions.grid import UNIFORM_176
from homeward.sources import clean_trips, corrupt_trips, raw_trips

T0 = 1451606400


def _dense(spark, n):
    """n outbound and n return trips between two points within 8 hours."""
    i = F.col("id")
    p, q = (-73.9, 40.7), (-73.95, 40.75)

    def side(start, a, b):
        t = F.lit(T0 + start) + i % 7000
        return spark.range(n).select(
            F.timestamp_seconds(t).alias("tpep_pickup_datetime"),
            F.timestamp_seconds(t + 300).alias("tpep_dropoff_datetime"),
            *[F.lit(v).alias(c) for c, v in zip(("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"), (*a, *b))],
        )

    return side(0, p, q).unionAll(side(10_000, q, p))


def test_dense_pair_of_cells_is_split(spark):
    trips = _dense(spark, 6000)
    sizes = _partition_sizes(match_return_trips(trips))
    assert sum(sizes) == 6000 * 6000
    assert max(sizes) <= sum(sizes) / 4


def _partition_sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_equal_trips_come_from_many_partitions(spark):
    """5,000 times the same outbound and 5,000 times the same return trip."""
    trips = _dense(spark, 1)
    trips = trips.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(5000)))).drop("_n").repartition(4)
    pairs = match_return_trips(trips)
    sizes = _partition_sizes(pairs)
    assert sum(sizes) == 5000 * 5000 and max(sizes) <= sum(sizes) / 4
    assert pairs.distinct().count() == 1


def _sides(spark, na, nb, equal=False):
    """Sides of two keys, one of them hot."""
    a = spark.range(na).select(F.lit(7).alias("k"), (F.lit(0) if equal else F.col("id")).alias("x"))
    b = spark.range(nb).select(F.lit(7).alias("r"), (F.lit(0) if equal else F.col("id")).alias("y"))
    more = spark.createDataFrame([(1, 5), (1, 5), (None, 3)], "k int, x long")
    return a.unionAll(more), b.unionAll(more.toDF("r", "y"))


@pytest.mark.parametrize("equal", [False, True])
def test_balanced_join_equals_join(spark, equal):
    a, b = _sides(spark, 300, 170, equal)
    near = F.abs(F.col("x") - F.col("y")) <= 3
    want = as_bag(a.join(b, (F.col("k") == F.col("r")) & near))
    for pairs in (1, 100, 10**6):
        assert as_bag(balanced_join(a, b, [("k", "r")], near, pairs)) == want


def test_balanced_join_of_empty_sides(spark):
    a, b = _sides(spark, 5, 5)
    assert balanced_join(a.limit(0), b, [("k", "r")], pairs=1).count() == 0
    assert balanced_join(a, b.limit(0), [("k", "r")], pairs=1).count() == 0


def test_grid_copies_rows_by_the_square_root(spark):
    for na, nb in ((6000, 6000), (20000, 300), (3, 50000)):
        heavy = heavy_keys(*_sides(spark, na, nb), [("k", "r")], pairs=40_000).first()
        assert (heavy["_na"], heavy["_nb"]) == (na, nb)
        fields = na * nb / (40_000 / 16)
        assert heavy["_rows"] * heavy["_cols"] >= min(fields, na * nb) * 0.99
        assert na * heavy["_cols"] + nb * heavy["_rows"] < 3 * fields**0.5 * (na + nb)


def test_hot_slot_of_a_gap_join_is_split(spark):
    a = spark.range(3000).select((F.col("id") % 50 + T0).alias("s"))
    b = spark.range(3000).select((F.col("id") % 50 + T0 + 100).alias("t"))
    sizes = _partition_sizes(gap_join(a, b, "s", "t", 1000))
    assert sum(sizes) == 9_000_000 and max(sizes) <= sum(sizes) / 4


def test_hot_cell_of_the_candidate_stage_is_split(spark):
    # 36 million candidates in one key; keys under the limit stay whole
    sizes = _partition_sizes(return_trip_candidates(_dense(spark, 6000)))
    assert max(sizes) <= sum(sizes) / 4


def test_few_scans(spark, sf_dir):
    plan = match_return_trips(clean_trips(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 2 and "Broadcast" not in plan


def test_rows_that_cannot_match_reach_no_exchange(spark, tmp_path):
    trips = _dense(spark, 50)
    bad = [F.lit(None).cast("double"), F.lit(float("nan")), F.lit(float("inf")), F.lit(float("-inf"))]
    rows = trips
    for b in bad:
        rows = rows.unionAll(trips.withColumn("pickup_latitude", b))
    rows = rows.unionAll(trips.withColumn("tpep_pickup_datetime", F.lit(None).cast("timestamp")))
    assert matchable(trip_table(rows)).count() == 100
    rows.write.parquet(str(tmp_path / "trips"))
    pairs = match_return_trips(spark.read.parquet(str(tmp_path / "trips")))
    assert pairs.count() == 2500
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Filter .*isnotnull\(pickup_latitude#\d+\).*\n.*Relation", plan)) == 2


def test_corrupt_coordinates(spark):
    trips = _dense(spark, 5)
    values = F.array(*[F.lit(v) for v in (1e300, -1e300, 1e17, 200.0, float("inf"), float("nan"))])
    rows = trips
    for column in ("pickup_latitude", "dropoff_longitude"):
        rows = rows.unionAll(trips.withColumn(column, F.explode(values)).select(*trips.columns))
    for kw in ({}, {"layout": Layout(pairs=1)}, {"neighbours": "fixed"}):
        assert match_return_trips(rows, **kw).count() == 25


def test_corrupt_trips_of_the_tables(spark, sf_dir):
    assert corrupt_trips(spark, sf_dir).count() > clean_trips(spark, sf_dir).count()
    assert match_return_trips(corrupt_trips(spark, sf_dir)).count() == 123


def test_partitions_grow_with_the_data(spark):
    n = [join_partitions(spark, size) for size in (None, 10**6, 10**11, 10**12, 10**13)]
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert n[0] == n[1] == least < n[2] and 9 * n[2] < n[3] < 11 * n[2] and 9 * n[3] < n[4]


def test_session_settings_stay(spark, sf_dir):
    before = dict(spark.conf.getAll)
    for name in ("return_trips", "return_trips_two_level", "spatial_bucket_join_count", "gap_join_count", "distance_gap_join_count", "return_trips_limited"):
        QUERIES[name](spark, sf_dir).count()
    assert dict(spark.conf.getAll) == before


def test_other_session_zone(spark, sf_dir):
    want = as_bag(with_epoch_seconds(match_return_trips(clean_trips(spark, sf_dir))))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert as_bag(with_epoch_seconds(match_return_trips(clean_trips(spark, sf_dir)))) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_uniform_grid_of_the_script(spark, sf_dir):
    trips = clean_trips(spark, sf_dir)
    assert match_adjacent_slots(trips, grid=UNIFORM_176, neighbours="fixed").count() == 368


def test_ordered_sample_in_two_levels(spark, sf_dir):
    trips = raw_trips(spark, sf_dir).repartition(40)
    order = trips.columns
    got = first_rows(trips, 300, order)
    want = trips.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(300)
    assert got.collect() == want.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert first_rows(trips, 300).count() == 300 and first_rows(trips, 10**6).count() == trips.count()


def test_large_ordered_sample_sends_no_more_than_its_rows(spark, sf_dir):
    """Over the session's limit of ranks cut in a task (1,000), every row was sent."""
    trips = raw_trips(spark, sf_dir).repartition(40)
    order = trips.columns
    got = first_rows(trips, 1500, order)
    want = trips.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(1500)
    assert got.collect() == want.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Window" not in plan and "Coalesce" in plan


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("shufflepartitionidpassthrough"), plan.count("Exchange hashpartitioning")


def test_clones_are_made_behind_the_exchange(spark, sf_dir):
    """Each side of the match has one exchange, of rows by wide cells; the
    fine clones stay in the partition that they are made in."""
    trips = clean_trips(spark, sf_dir).repartition(8)
    for pairs in (match_return_trips(trips), match_adjacent_slots(trips, grid=UNIFORM_176, neighbours="fixed")):
        assert _exchanges(pairs) == (2, 0)


def test_keys_of_a_coarse_fixed_grid_are_cut(spark):
    from homeward.functions.grid import METRIC, CellKeys

    assert 100 <= CellKeys(UNIFORM_176, 100.0, "fixed").parts.grid.cell_height_m() < 110
    assert CellKeys(METRIC, 100.0, "fixed").parts.grid == METRIC


def test_fields_are_no_smaller_than_the_whole_join_needs(spark):
    """Two thousand keys of 400 candidates over 8 partitions: with a limit of
    16, each was cut into a field for each candidate and copied 20 times."""
    from homeward.operators.balanced import Buckets

    side = spark.range(40_000).select((F.col("id") % 2000).alias("k"))
    buckets = Buckets(side, side.toDF("r"), [("k", "r")], 8)
    n, pairs, field = buckets.share(16, 8)
    heavy = heavy_keys(side, side.toDF("r"), [("k", "r")], pairs, n, buckets, field)
    assert (n, pairs, heavy.count()) == (8, 16, 2000)
    assert heavy.agg(F.max(F.col("_rows") * F.col("_cols"))).first()[0] == 1
