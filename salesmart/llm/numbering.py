"""Row numbers over a whole table, without bringing its rows together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm import shared

_IN_PARTITION = (1 << 33) - 1  # the bits of monotonically_increasing_id() that count within one


def numbered(rows: DataFrame, order: Sequence[Column], name: str = "number") -> DataFrame:
    """``rows`` with a column ``name``: their places from 0 in the order given.

    Rows are dealt into ranges, sorted there and stored with their place in the range; the
    ranges' sizes, one row each, are added up and handed to every row. Rows that ``order`` does not tell
    apart are numbered in any order and may lie in different ranges, so a key that very many rows share
    is not one task's work. An empty table gives an empty one.
    """
    tied = rows.withColumn("__tie", F.monotonically_increasing_id())
    sorted_ = tied.repartitionByRange(*order, F.col("__tie")).sortWithinPartitions(*order, F.col("__tie"))
    held = shared.stored(
        sorted_.drop("__tie").select(
            "*",
            F.spark_partition_id().alias("__range"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)).alias("__place"),
        ),
        "numbered",
    )
    sizes = held.groupBy("__range").agg(F.count("*").alias("__size"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__first"))
    # One row for each task that wrote a range, whatever the rows' number.
    both = held.join(F.broadcast(firsts), "__range")
    return both.withColumn(name, F.col("__first") + F.col("__place")).drop("__range", "__place", "__first")
