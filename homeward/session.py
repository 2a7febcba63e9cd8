"""Session settings.

The library runs in the caller's session as it is and changes none of its
settings.  ``tune`` is for sessions that a job owns: larger shuffle
partitions than Spark's defaults; ``local_session`` builds a session for
tests, benchmarks and the job script.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """The shared checkpoint folder the cluster names; ``fallback`` is set
    only when none is configured (tests)."""
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if fallback:
        spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process and so share local folders."""
    master = spark.conf.get("spark.master", "")
    return master.startswith("local") and not master.startswith("local-cluster")


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, for small tables that plans are made from: a
    written table in the shared checkpoint folder, so that its real size is
    known and no executor's loss costs it.  A local folder is made only where
    none is configured and the master is local; without any, it is cached."""
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    if not base and is_local(spark):
        base = checkpoint_dir(spark, tempfile.mkdtemp(prefix="homeward-"))
    if not base:
        return df.persist()
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_session(
    cores: int | str = "*", shuffle_partitions: int | None = None, app: str = "homeward", memory: str | None = None
) -> SparkSession:
    """A local session; ``memory`` of its JVM (default: half of the machine's)."""
    if memory is None:
        memory = f"{max(1, os.sysconf('SC_PAGE_SIZE') * os.sysconf('SC_PHYS_PAGES') >> 31)}g"
    parts = shuffle_partitions or (8 if cores == "*" else int(cores))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
