"""What several operators need: the shared folder, stored tables, Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# Rows and bytes that Spark hands to Python at once; texts differ in length by orders of
# magnitude, so the bytes are what bounds a worker's memory.
BATCH_ROWS = 2_000
BATCH_BYTES = 8 << 20

_meanwhile: list[list[str]] = []


def folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it.

    Only a local session that names none gets one of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="salesmart-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def new_path(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there."""
    spark = df.sparkSession
    path = new_path(spark, name)
    if _meanwhile:
        _meanwhile[-1].append(path)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that are stored meanwhile; what is kept must have been written before."""
    _meanwhile.append([])
    try:
        yield
    finally:
        for path in _meanwhile.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete what lies at ``path`` in the shared folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    target.getFileSystem(conf).delete(target, True)


def discard(df: DataFrame | None) -> None:
    """Delete a table of ``stored`` that nothing reads any more."""
    path = getattr(df, "_stored_at", None)
    if path is not None:
        remove(df.sparkSession, path)


def bound_batches(spark: SparkSession) -> None:
    """Bound what Spark hands to Python at once, unless the session bounds it tighter.

    Python workers also get the place of this package; on other machines it must be installed.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    for key, most in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
    ):
        now = spark.conf.get(key, None)
        size = int(now) if now and now.isdigit() else 0
        if not 0 < size <= most:
            spark.conf.set(key, str(most))


def by_bytes(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES // 2) -> Iterator[pa.RecordBatch]:
    """Slices of the batch whose ``column`` holds about ``most`` bytes, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch[column]), 0).to_pylist()
    start = held = 0
    for row, length in enumerate(lengths):
        if row > start and held + length > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += length
    if start < len(lengths):
        yield batch.slice(start)
