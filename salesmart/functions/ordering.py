"""Sort keys with NULLs last, ascending and descending alike."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascending(columns: Iterable[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def descending(columns: Iterable[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]
