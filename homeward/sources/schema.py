"""Trip schema and the column roles the matcher works on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The 19 fields of a yellow-cab trip record, in file order.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.StringType(), False),
        T.StructField("tpep_pickup_datetime", T.TimestampType(), False),
        T.StructField("tpep_dropoff_datetime", T.TimestampType(), False),
        T.StructField("passenger_count", T.IntegerType(), False),
        T.StructField("trip_distance", T.DoubleType(), False),
        T.StructField("pickup_longitude", T.DoubleType(), False),
        T.StructField("pickup_latitude", T.DoubleType(), False),
        T.StructField("RatecodeID", T.IntegerType(), False),
        T.StructField("store_and_fwd_flag", T.StringType(), False),
        T.StructField("dropoff_longitude", T.DoubleType(), False),
        T.StructField("dropoff_latitude", T.DoubleType(), False),
        T.StructField("payment_type", T.IntegerType(), False),
        T.StructField("fare_amount", T.DoubleType(), False),
        T.StructField("extra", T.DoubleType(), False),
        T.StructField("mta_tax", T.DoubleType(), False),
        T.StructField("tip_amount", T.DoubleType(), False),
        T.StructField("tolls_amount", T.DoubleType(), False),
        T.StructField("improvement_surcharge", T.DoubleType(), False),
        T.StructField("total_amount", T.DoubleType(), False),
    ]
)

TRIP_FIELDS = tuple(f.name for f in TRIP_SCHEMA.fields)


@dataclass(frozen=True)
class TripColumns:
    """Names of the six columns a match needs, in the input DataFrame."""

    pickup_ts: str = "tpep_pickup_datetime"
    dropoff_ts: str = "tpep_dropoff_datetime"
    pickup_lon: str = "pickup_longitude"
    pickup_lat: str = "pickup_latitude"
    dropoff_lon: str = "dropoff_longitude"
    dropoff_lat: str = "dropoff_latitude"

    def names(self) -> tuple[str, ...]:
        return (
            self.pickup_ts,
            self.dropoff_ts,
            self.pickup_lon,
            self.pickup_lat,
            self.dropoff_lon,
            self.dropoff_lat,
        )


YELLOW_CAB = TripColumns()

# Canonical short names used inside the matcher and in its output
# (``to_`` / ``back_`` prefixed).
CANONICAL = (
    "pickup_ts",
    "dropoff_ts",
    "pickup_lon",
    "pickup_lat",
    "dropoff_lon",
    "dropoff_lat",
)
