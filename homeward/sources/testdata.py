"""Trip tables derived from the ``lineitem`` test table.

The shared test tables hold no coordinates, so trips are computed from
``lineitem`` columns with integer and double arithmetic that Spark and
DuckDB evaluate identically.  The work grows with ``lineitem``: one trip
per line item (plus the duplicates of the dirty variant).

Clean trips (``trips_from_lineitem``), with ``k = l_orderkey`` and
``n = l_linenumber``: 100 hubs about 125 m apart around (-74.0, 40.7),
each point jittered by up to about 55 m, pickups spread over 30 days of
January 2016, durations of 2 to 52 minutes.

Dirty trips (``trips_raw``) carry all 19 fields and add missing GPS,
negative durations, exact duplicates and fare-only duplicates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import TRIP_FIELDS

# Fixed values of the derivation (shared with the DuckDB oracle SQL).
HUBS = 100
EPOCH_2016_01_01 = 1451606400
SPAN_S = 2592000  # 30 days
BASE_LON = -74.0
BASE_LAT = 40.7
HUB_STEP_LON = 0.0015
HUB_STEP_LAT = 0.0011
JITTER_DEG = 1e-5


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def _lon(hub: Column, k: Column, mult: int) -> Column:
    return F.lit(BASE_LON) + (hub % 10) * F.lit(HUB_STEP_LON) + (((k * mult) % 101) - 50) * F.lit(JITTER_DEG)


def _lat(hub: Column, k: Column, mult: int) -> Column:
    return (
        F.lit(BASE_LAT)
        + F.floor(hub / 10) * F.lit(HUB_STEP_LAT)
        + (((k * mult) % 89) - 44) * F.lit(JITTER_DEG)
    )


def _trip_parts(li: DataFrame) -> DataFrame:
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    ph = F.col("l_partkey") % HUBS
    dh = (F.col("l_suppkey") * 7 + n * 13) % HUBS
    pickup_s = (k * 7919 + n * 104729) % SPAN_S + EPOCH_2016_01_01
    dropoff_s = pickup_s + 120 + (F.col("l_partkey") * 31 + n) % 3000
    return li.select(
        "*",
        pickup_s.alias("_pickup_s"),
        dropoff_s.alias("_dropoff_s"),
        _lon(ph, k, 3).alias("_pickup_lon"),
        _lat(ph, k, 5).alias("_pickup_lat"),
        _lon(dh, k, 7).alias("_dropoff_lon"),
        _lat(dh, k, 11).alias("_dropoff_lat"),
    )


def trips_from_lineitem(li: DataFrame) -> DataFrame:
    """Clean trips, six columns with the yellow-cab names."""
    t = _trip_parts(li)
    return t.select(
        F.timestamp_seconds("_pickup_s").alias("tpep_pickup_datetime"),
        F.timestamp_seconds("_dropoff_s").alias("tpep_dropoff_datetime"),
        F.col("_pickup_lon").alias("pickup_longitude"),
        F.col("_pickup_lat").alias("pickup_latitude"),
        F.col("_dropoff_lon").alias("dropoff_longitude"),
        F.col("_dropoff_lat").alias("dropoff_latitude"),
    )


def trips_raw(li: DataFrame) -> DataFrame:
    """Dirty trips with all 19 fields.

    * ``k % 97 = 0``: pickup longitude and latitude are 0.0 (missing GPS);
    * ``k % 89 = 0``: dropoff 60 s before pickup, dropoff coordinates equal
      to the (unzeroed) pickup position;
    * rows with ``k % 50 = 0`` appear twice (exact duplicates);
    * rows with ``k % 50 = 1`` appear once more with ``fare_amount + 1``.
    """
    t = _trip_parts(li)
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    no_gps = (k % 97) == 0
    backwards = (k % 89) == 0
    pickup_s = F.col("_pickup_s")
    dropoff_s = F.when(backwards, pickup_s - 60).otherwise(F.col("_dropoff_s"))
    rows = t.select(
        (F.lit(1) + n % 2).cast("string").alias("VendorID"),
        F.timestamp_seconds(pickup_s).alias("tpep_pickup_datetime"),
        F.timestamp_seconds(dropoff_s).alias("tpep_dropoff_datetime"),
        n.cast("int").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.when(no_gps, F.lit(0.0)).otherwise(F.col("_pickup_lon")).alias("pickup_longitude"),
        F.when(no_gps, F.lit(0.0)).otherwise(F.col("_pickup_lat")).alias("pickup_latitude"),
        F.lit(1).alias("RatecodeID"),
        F.lit("N").alias("store_and_fwd_flag"),
        F.when(backwards, F.col("_pickup_lon")).otherwise(F.col("_dropoff_lon")).alias("dropoff_longitude"),
        F.when(backwards, F.col("_pickup_lat")).otherwise(F.col("_dropoff_lat")).alias("dropoff_latitude"),
        (F.lit(1) + F.col("l_suppkey") % 4).cast("int").alias("payment_type"),
        F.col("l_quantity").alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        F.lit(0.0).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        F.col("l_quantity").alias("total_amount"),
        k.alias("_k"),
    )
    exact_dups = rows.where((F.col("_k") % 50) == 0)
    fare_dups = rows.where((F.col("_k") % 50) == 1).withColumn("fare_amount", F.col("fare_amount") + 1)
    return rows.unionByName(exact_dups).unionByName(fare_dups).select(*TRIP_FIELDS)


def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_lineitem(lineitem(spark, sf_dir))


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_raw(lineitem(spark, sf_dir))


def corrupt_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean trips, and again those with ``k % 40 < 6`` with a corrupt pickup
    latitude: NULL, NaN, infinity, 1e300, 1e17, 200 degrees."""
    li = lineitem(spark, sf_dir)
    kind = F.col("l_orderkey") % 40
    out = trips_from_lineitem(li)
    bad = [F.lit(None).cast("double"), F.lit(float("nan")), F.lit(float("inf")), F.lit(1e300), F.lit(1e17), F.lit(200.0)]
    for i, b in enumerate(bad):
        out = out.unionByName(trips_from_lineitem(li.where(kind == i)).withColumn("pickup_latitude", b))
    return out
