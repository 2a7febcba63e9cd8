"""Readers for trip files.

CSV is read with the fixed 19-field schema and a header row, never with
schema inference (an inference pass reads the whole input once more).
Parquet and ORC carry their own schema.  Every reader returns a lazy
DataFrame: column pruning and filters written later reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .schema import TRIP_SCHEMA


def read_trips_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Trip CSV with a header row and the explicit trip schema.

    Unparsable values become NULL (permissive mode); the declared
    ``nullable=False`` is not enforced by file sources.
    """
    return spark.read.schema(TRIP_SCHEMA).option("header", True).csv(path)


def read_trips(spark: SparkSession, path: str | list[str], fmt: str | None = None) -> DataFrame:
    """Read trips from ``csv``, ``parquet`` or ``orc``; the format defaults
    to the file extension of ``path`` (CSV if unknown)."""
    if fmt is None:
        first = path if isinstance(path, str) else path[0]
        lowered = first.rstrip("/").lower()
        fmt = "parquet" if lowered.endswith(".parquet") else "orc" if lowered.endswith(".orc") else "csv"
    if fmt == "csv":
        return read_trips_csv(spark, path)
    if fmt in ("parquet", "orc"):
        return spark.read.format(fmt).load(path)
    raise ValueError(f"unsupported trip format: {fmt!r}")
