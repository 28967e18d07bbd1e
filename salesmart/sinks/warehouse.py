"""Stored tables under one root, replaced as a whole or by the month.

A table is written beside its place and put there by renames once it is complete. Whatever
stops a run before that leaves the old table; what stops it between the renames is made good
by ``recover``, which every run and reader starts with.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.ordering import ascending
from salesmart.operators.curve import curve_position
from salesmart.sinks.scratch import stored

MONTH, CURVE = "month", "_curve"
LAYERS = ("raw", "stg", "mart", "quarantine", "audit")
# Names that readers pass over, as they begin with an underscore.
_NEW, _OLD = "_new-{id}-{name}", "_old-{id}-{name}"
_LEFT = re.compile(r"_(new|old)-[0-9a-f]{32}-(.+)")


@dataclass
class Warehouse:
    """Parquet tables at ``root/layer/name``; ``tables`` holds those of this run."""

    spark: SparkSession
    root: str
    tables: dict[str, tuple[str, T.StructType]] = field(default_factory=dict)
    written: dict[str, int] = field(default_factory=dict)  # rows that each write counted

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> Warehouse:
        """The tables that lie under ``root``, written by whichever run."""
        found = cls(spark, root)
        found.recover()
        for layer in LAYERS:
            for name in found._children(f"{found.root.rstrip('/')}/{layer}"):
                if not name.startswith(("_", ".")):
                    schema = spark.read.parquet(found.path(layer, name)).schema
                    found.tables[name] = (layer, schema)
        return found

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def replace(
        self,
        layer: str,
        name: str,
        df: DataFrame,
        order: Sequence[str] = (),
        by_month_of: str | None = None,
        cluster: Sequence[str] = (),
        files: int | None = None,
    ) -> DataFrame:
        """Write ``df`` as the new content of the table and return the stored table.

        ``order`` gives range-partitioned, sorted files: rows in that order within a
        file and from file to file, with no single-task global sort. The other columns
        only split the rows of a key that has very many of them.
        ``by_month_of`` names a date column to partition the directory by month; the
        range then starts with the month, so a task writes few directories. ``cluster`` names
        columns to lay the rows by on a curve through all of them, before ``order``: filters
        on any one of these skip files. ``files`` is the number of ranges, else as many as
        the session has shuffle partitions. Rows are counted as they are written.
        """
        path = self.path(layer, name)
        aside = self._beside(path, _NEW)
        columns = df.columns
        schema = self._write(df, name, aside, order, by_month_of, cluster, files)
        self._swap(aside, path)
        self.tables[name] = (layer, schema)
        return self.read(name).select(*columns)

    def replace_months(
        self,
        layer: str,
        name: str,
        df: DataFrame,
        months: Sequence[str],
        by_month_of: str,
        order: Sequence[str] = (),
    ) -> DataFrame:
        """Write the rows of ``months`` ("2025-01") anew; the files of all others stay.

        Months without rows are emptied. Each month is put in place by itself, so a reader
        sees it old or new. The table must be partitioned by month, or not be there yet.
        """
        path = self.path(layer, name)
        kept = [c for c in self._children(path, files=True) if not c.startswith(("_", "."))]
        if kept and not all(c.startswith(f"{MONTH}=") for c in kept):
            raise ValueError(f"{path} is not partitioned by month")
        wanted = df.filter(F.date_format(by_month_of, "yyyy-MM").isin(list(months)))
        aside = self._beside(path, _NEW)
        schema = self._write(wanted, name, aside, order, by_month_of)
        self._make(path)
        for month in dict.fromkeys(months):
            self._swap(f"{aside}/{MONTH}={month}", f"{path}/{MONTH}={month}")
        self._delete(aside)
        self.tables[name] = (layer, schema)
        return self.read(name).select(*df.columns)

    def _write(
        self,
        df: DataFrame,
        name: str,
        path: str,
        order: Sequence[str],
        by_month_of: str | None,
        cluster: Sequence[str] = (),
        files: int | None = None,
    ) -> T.StructType:
        columns = df.columns
        keys = list(order)
        if cluster:
            df = stored(df, name)
            df = df.withColumn(CURVE, curve_position(df, cluster))
            keys = [CURVE, *keys]
        if by_month_of:
            df = df.withColumn(MONTH, F.date_format(by_month_of, "yyyy-MM"))
            keys = [MONTH, *keys]
        if keys:
            rest = [c for c in columns if c not in keys]
            by = ascending([*keys, *rest])
            df = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
            df = df.sortWithinPartitions(*ascending(keys)).drop(CURVE)
        # Above the range exchange: what lies below it is run once more, to sample the ranges.
        counted = Observation(f"{name}-{uuid.uuid4().hex}")
        writer = df.observe(counted, F.count(F.lit(1)).alias("n_rows")).write
        if by_month_of:
            writer = writer.partitionBy(MONTH)
        writer.parquet(path)
        self.written[name] = counted.get.get("n_rows", 0)
        return df.schema

    def read(self, name: str) -> DataFrame:
        """A table of this run; with a month partition it has the ``month`` column too."""
        layer, schema = self.tables[name]
        return self.spark.read.schema(schema).parquet(self.path(layer, name))

    def counts(self) -> DataFrame:
        """``(layer, table, n_rows)`` of this run's tables, as counted while they were written."""
        rows = [(self.tables[n][0], n, self.written[n]) for n in sorted(self.written)]
        return self.spark.createDataFrame(rows, "layer string, table string, n_rows long")

    # files -------------------------------------------------------------------------
    def _at(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return target.getFileSystem(conf), target

    def _beside(self, path: str, pattern: str) -> str:
        parent, name = path.rsplit("/", 1)
        return f"{parent}/{pattern.format(id=uuid.uuid4().hex, name=name)}"

    def _children(self, path: str, files: bool = False) -> list[str]:
        fs, target = self._at(path)
        if not fs.exists(target):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(target) if files or s.isDirectory())

    def _make(self, path: str) -> None:
        fs, target = self._at(path)
        fs.mkdirs(target)

    def _delete(self, path: str) -> None:
        fs, target = self._at(path)
        fs.delete(target, True)

    def _rename(self, source: str, to: str) -> None:
        fs, target = self._at(source)
        if not fs.rename(target, self._at(to)[1]):
            raise OSError(f"{source} could not be renamed to {to}")

    def _swap(self, new: str, path: str) -> None:
        """Put the directory ``new`` in the place of ``path``; without ``new`` empty that."""
        old = None
        fs, target = self._at(path)
        if fs.exists(target):
            old = self._beside(path, _OLD)
            self._rename(path, old)
        if fs.exists(self._at(new)[1]):
            self._rename(new, path)
        if old:
            self._delete(old)

    def recover(self) -> None:
        """Undo or finish what a stopped run left: old tables back in place, unfinished ones away."""
        root = self.root.rstrip("/")
        for layer in LAYERS:
            inside = [c for c in self._children(f"{root}/{layer}") if not _LEFT.fullmatch(c)]
            for folder in (f"{root}/{layer}", *(f"{root}/{layer}/{name}" for name in inside)):
                for child in self._children(folder):
                    left = _LEFT.fullmatch(child)
                    if not left:
                        continue
                    place = f"{folder}/{left[2]}"
                    fs, target = self._at(place)
                    if left[1] == "old" and not fs.exists(target):
                        self._rename(f"{folder}/{child}", place)
                    else:
                        self._delete(f"{folder}/{child}")

    # names -------------------------------------------------------------------------
    def register_tables(self, database: str) -> None:
        """Make every table known to the session's catalog as ``database.name``.

        The tables stay where they are; the catalog holds their place and schema, so sessions
        that share it can ask for them by name. Run again after a change of schema.
        """
        quoted = f"`{database}`"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted}")
        for name, (layer, schema) in self.tables.items():
            table = f"{quoted}.`{name}`"
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            months = f"PARTITIONED BY (`{MONTH}`)" if MONTH in schema.names and self._by_month(layer, name) else ""
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.spark.sql(
                f"CREATE TABLE {table} ({fields}) USING parquet {months} LOCATION '{self.path(layer, name)}'"
            )
            if months:
                self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")

    def _by_month(self, layer: str, name: str) -> bool:
        return any(c.startswith(f"{MONTH}=") for c in self._children(self.path(layer, name)))

    def register_views(self) -> None:
        """Make every table of this run known to ``spark.sql`` by its name."""
        for name in self.tables:
            self.read(name).createOrReplaceTempView(name)


def row_counts(tables: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """``(layer, table, n_rows)`` for ``{table: (layer, df)}``, in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table"), "n_rows"
        )
        for name, (layer, df) in tables.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def differing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in one table but not in the other, copies counted: empty if they are equal."""
    right = right.select(*left.columns)
    return left.exceptAll(right).unionByName(right.exceptAll(left))
