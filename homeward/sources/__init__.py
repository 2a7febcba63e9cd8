from .loaders import read_trips, read_trips_csv
from .schema import CANONICAL, TRIP_FIELDS, TRIP_SCHEMA, YELLOW_CAB, TripColumns
from .testdata import clean_trips, corrupt_trips, raw_trips, trips_from_lineitem, trips_raw

__all__ = [
    "CANONICAL",
    "TRIP_FIELDS",
    "TRIP_SCHEMA",
    "YELLOW_CAB",
    "TripColumns",
    "clean_trips",
    "corrupt_trips",
    "raw_trips",
    "read_trips",
    "read_trips_csv",
    "trips_from_lineitem",
    "trips_raw",
]
