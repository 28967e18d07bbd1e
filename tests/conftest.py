from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from salesmart.session import build_session


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _value(value, kind: T.DataType):
    if value is None:
        return None
    if isinstance(kind, T.DateType):
        return dt.date.fromisoformat(value)
    if isinstance(kind, T.DecimalType):
        return Decimal(str(value))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return float(value)
    return value


@pytest.fixture(scope="session")
def make(spark):
    """Rows as dicts, missing columns NULL, under a declared schema."""

    def build(schema: T.StructType, *rows: dict) -> DataFrame:
        data = [tuple(_value(row.get(f.name), f.dataType) for f in schema) for row in rows]
        return spark.createDataFrame(data, schema)

    return build


def rows_of(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as sorted tuples: dates as ISO text, decimals as floats."""

    def plain(value):
        if isinstance(value, dt.date):
            return value.isoformat()
        return float(value) if isinstance(value, Decimal) else value

    found = [tuple(plain(v) for v in row) for row in df.select(*(columns or df.columns)).collect()]
    return sorted(found, key=lambda row: [(v is None, str(type(v)), v) for v in row])
