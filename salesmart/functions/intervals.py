"""Day intervals as aligned power-of-two blocks.

A closed interval of days splits into at most two aligned blocks per level, and a
day lies in exactly one block of each level. "Which intervals hold this day" then is
an equality join on (level, block): no range condition has to be tried against every
interval of a key, so a key with very many intervals costs no more than its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Days from 0001-01-01 to 9999-12-31 number 3,652,059, below 2**22.
LEVELS = 22


def day_number(date: Column) -> Column:
    return F.datediff(date, F.lit("0001-01-01").cast("date"))


def _shift(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits)


def with_interval_blocks(df: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per block of ``[first, last]``, in columns ``level`` and ``block``.

    An open end is NULL in ``last``. A row without a start, or ending before it
    starts, has no block.
    """
    start = day_number(first)
    stop = F.coalesce(day_number(last) + 1, F.lit(1 << LEVELS))
    level = F.col("level")
    ceil_start = _shift(start + _shift(F.lit((1 << LEVELS) - 1), F.lit(LEVELS) - level), level)
    floor_stop = _shift(stop, level)
    odd_start = F.when((ceil_start < floor_stop) & (ceil_start % 2 == 1), ceil_start)
    odd_stop = F.when((ceil_start < floor_stop) & (floor_stop % 2 == 1), floor_stop - 1)
    return df.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS)))).withColumn(
        "block", F.explode(F.array_compact(F.array(odd_start, odd_stop)))
    )


def with_day_blocks(df: DataFrame, date: Column) -> DataFrame:
    """One row per block that holds the day, one for each level."""
    return df.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS)))).withColumn(
        "block", _shift(day_number(date), F.col("level"))
    )
