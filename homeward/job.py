"""Batch job: read trips, drop trips with zero coordinates, match, report.

    spark-submit homeward/job.py INPUT [--format csv|parquet|orc]
        [--variant canonical|clean|distinct|adjacent] [--output PATH]
        [--stage [SHARED_FOLDER]]

Prints the number of matches and the elapsed time.  With ``--output`` the
pairs are written as parquet (overwrite); the write is the job's only
action, so matches are computed once.  Without it only the count runs.
"""

from __future__ import annotations

import argparse
import sys
import time
import uuid

from pyspark.sql import SparkSession

from homeward.operators.clean import nonzero_coordinates
from homeward.operators.summary import count_rows
from homeward.plans.return_trips import match_adjacent_slots, match_return_trips
from homeward.session import checkpoint_dir, is_local, tune
from homeward.sources.loaders import read_trips


def stage_target(spark: SparkSession, folder: str | None) -> str:
    """A new folder for the staged input below ``folder`` (by default the
    cluster's ``spark.checkpoint.dir``), which all executors must share: on a
    cluster, a folder without a scheme or of the local file system is only
    taken when it is the one the cluster names."""
    shared = checkpoint_dir(spark)
    folder = folder or shared
    if not folder:
        raise ValueError("--stage needs a folder or spark.checkpoint.dir")
    local = folder.startswith("file:") or "://" not in folder
    named = shared is not None and folder.removeprefix("file:").startswith(shared.removeprefix("file:"))
    if local and not named and not is_local(spark):
        raise ValueError(f"{folder} is a folder of one machine; name a shared one")
    return folder.rstrip("/") + f"/homeward-stage-{uuid.uuid4().hex}"


def stage(spark: SparkSession, trips, target: str):
    """Write the filtered trips once as parquet and read them back: the key
    count and the match then scan columns instead of parsing text, and the
    lineage to the text parse is cut."""
    trips.write.parquet(target)
    return spark.read.parquet(target)


def remove(spark: SparkSession, target: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def build(spark: SparkSession, path: str, fmt: str | None, variant: str, staging: str | None = None):
    trips = nonzero_coordinates(read_trips(spark, path, fmt))
    if staging is not None:
        trips = stage(spark, trips, staging)
    if variant == "adjacent":
        return match_adjacent_slots(trips)
    return match_return_trips(trips, clean=variant == "clean", distinct=variant == "distinct")


def run(spark: SparkSession, args: argparse.Namespace) -> tuple[int, float]:
    start = time.perf_counter()
    target = None if args.stage is None else stage_target(spark, args.stage)
    try:
        pairs = build(spark, args.input, args.format, args.variant, target)
        if args.output:
            pairs.write.mode("overwrite").parquet(args.output)
            n = spark.read.parquet(args.output).count()  # from file footers
        else:
            n = count_rows(pairs).collect()[0]["n"]
    finally:
        if target is not None:
            remove(spark, target)
    return n, time.perf_counter() - start


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("input")
    ap.add_argument("--format", default=None)
    ap.add_argument("--variant", default="canonical", choices=["canonical", "clean", "distinct", "adjacent"])
    ap.add_argument("--output", default=None)
    ap.add_argument(
        "--stage",
        nargs="?",
        const="",
        default=None,
        help="write the filtered input as parquet first (to this shared folder, default spark.checkpoint.dir)",
    )
    return ap.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse(argv)
    spark = tune(SparkSession.builder.appName("return trips").getOrCreate())
    n, elapsed = run(spark, args)
    print(f"matches: {n}")
    print(f"elapsed: {elapsed:.3f} s")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
