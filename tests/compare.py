"""Run a query and its SQL on the same tables and compare them row by row."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime) and value.time() == dt.time():
        return value.date()
    return value


# Number families that hold the same values on both sides.
KINDS = {
    "bigint": "int",
    "int": "int",
    "integer": "int",
    "double": "float",
    "float": "float",
    "string": "text",
    "varchar": "text",
    "date": "date",
    "boolean": "bool",
}


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, in words; empty if the two agree exactly."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    kinds = {n: KINDS.get(str(d[1]).lower(), str(d[1])) for n, d in zip(names, result.description)}
    ours = {n: KINDS.get(t, t) for n, t in df.dtypes}
    wrong = [f"{n}: {ours[n]} against {kinds[n]}" for n in names if ours[n] != kinds[n]]
    order = sorted(names)
    at = [names.index(n) for n in order]
    theirs = Counter(tuple(_plain(row[i]) for i in at) for row in result.fetchall())
    found = Counter(tuple(_plain(v) for v in row) for row in df.select(*order).collect())
    if found != theirs:
        only_found = list((found - theirs).items())[:3]
        only_theirs = list((theirs - found).items())[:3]
        wrong.append(
            f"{found.total()} rows against {theirs.total()}; "
            f"{(found - theirs).total()} differ; ours {only_found}; theirs {only_theirs}"
        )
    return wrong
