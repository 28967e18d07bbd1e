"""Delimited files, read by header name under a declared schema."""

from __future__ import annotations

import csv
import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

SEPARATORS = (",", ";", "\t", "|")
BYTE_ORDER_MARK = "\ufeff"


def read_header(spark: SparkSession, path: str, sep: str | None = None) -> tuple[str, list[str]]:
    """Separator and column names by the first line: the separator that occurs most in it."""
    first = spark.read.text(path).first()
    line = first.value.removeprefix(BYTE_ORDER_MARK) if first else ""
    sep = sep or max(SEPARATORS, key=line.count)
    return sep, next(csv.reader([line], delimiter=sep), [])


def read_text_columns(
    spark: SparkSession, path: str, schema: T.StructType, sep: str | None = None
) -> DataFrame:
    """The schema's columns as strings, found by header name; empty fields are NULL.

    Column order in the file is free and further columns are left out. A directory of
    files is read whole; files whose headers differ from one another raise.
    """
    sep, names = read_header(spark, path, sep)
    raw = (
        spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("sep", sep)
        .csv(path)
    )
    return raw.select(*[F.nullif(F.col(f.name), F.lit("")).alias(f.name) for f in schema])


def typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast string columns to the schema; under ANSI a malformed value raises."""
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, sep: str | None = None
) -> DataFrame:
    return typed(read_text_columns(spark, path, schema, sep), schema)


def read_optional(
    spark: SparkSession, path: str, schema: T.StructType, sep: str | None = None
) -> DataFrame | None:
    """As ``read_csv``, or None with a warning where the path does not exist."""
    return if_present(lambda: read_csv(spark, path, schema, sep), path)


def if_present(read: Callable[[], DataFrame], path: str) -> DataFrame | None:
    """What ``read`` gives, or None with a warning where its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("%s not found, skipped", path)
        return None


def split_castable(raw: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, typed, and the others as read.

    The others carry ``bad_columns``, the names of the columns that do not cast. For
    runs that should go on past malformed values instead of failing on the first.
    """
    not_text = [f for f in schema if not isinstance(f.dataType, T.StringType)]
    failed = [
        F.when(
            F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name)
        )
        for f in not_text
    ]
    marked = raw.withColumn("bad_columns", F.array_compact(F.array(*failed)))
    good = marked.filter(F.size("bad_columns") == 0).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    )
    bad = marked.filter(F.size("bad_columns") > 0)
    return good, bad
