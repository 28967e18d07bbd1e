"""Rows of an order dealt into ranges, so that one key, or one day of it, is many tasks' work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.ordering import ascending
from salesmart.sinks.scratch import stored

RANGE, TIE = "_range", "_tie"


def ranged(df: DataFrame, order: Sequence[str], number: int | None = None) -> DataFrame:
    """``df`` with ``_range``, the number of the range that a row lies in, and ``_tie``.

    The ranges follow one another in the order of ``order`` and then ``_tie``, which tells
    rows apart that are equal in all of it: these too are split. Every range has about as
    many rows. The ranges are cut from a sample, so they are stored before they are used. Without
    ``number`` there are as many as shuffle partitions, of which AQE merges small ones.
    """
    tied = df.withColumn(TIE, F.monotonically_increasing_id())
    keys = ascending([*order, TIE])
    dealt = tied.repartitionByRange(number, *keys) if number else tied.repartitionByRange(*keys)
    return stored(dealt.withColumn(RANGE, F.spark_partition_id()), "ranges")
