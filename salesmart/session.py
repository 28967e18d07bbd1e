"""Spark session for the batch job."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# What the results rely on, whatever the cluster's defaults are: ANSI casts fail on
# malformed values, and dates do not depend on the host's time zone.
REQUIRED = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# AQE picks the final partition count and join side from measured sizes, and splits
# skewed join partitions also where that costs one more shuffle.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

SHUFFLE_BYTES_PER_TASK = 128 << 20


def build_session(app: str = "salesmart", **extra: str) -> SparkSession:
    """The session in force, or a new one; ``extra`` goes to the builder as it is."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    for key, value in {**REQUIRED, **ADAPTIVE, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require(spark: SparkSession) -> None:
    """Put the settings the results rely on in force on a session made elsewhere."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)


def shuffle_partitions(input_bytes: int, floor: int) -> int:
    """Shuffle tasks that hold about 128 MiB each of an input this large."""
    return max(floor, -(-input_bytes // SHUFFLE_BYTES_PER_TASK))


def size_shuffles(spark: SparkSession, path: str) -> None:
    """Let AQE start from as many shuffle partitions as the input's size calls for.

    AQE merges small partitions afterwards but never raises their number. A number set
    on the session stays. Only file lengths are read.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(key, None) is not None:
        return
    lengths = spark.read.format("binaryFile").load(path).agg(F.sum("length").alias("n"))
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = shuffle_partitions(lengths.first().n or 0, floor)
    if wanted > floor:
        spark.conf.set(key, str(wanted))
