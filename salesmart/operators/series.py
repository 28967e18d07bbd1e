"""Running and rolling sums over ordered series, split where a series is very long.

A window sorts all rows of a partition in one task. Here the partition is a part of a
series: what a part has to know of the ones before it is computed from per-part totals
and handed to it as one more row, so a series that holds much of the data is worked on
by many tasks. Results equal the plain window's, NULLs included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.ordering import ascending
from salesmart.operators.ranges import RANGE, TIE, ranged
from salesmart.schemas import TOTAL

SERIES = ["region", "chain_name", "product_group"]
# Rows per part of a rolling sum; a series shorter than this is one part.
BLOCK_ROWS = 8192


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    parts: Sequence[Sequence[str]] = (),
    upto: int = 0,
) -> DataFrame:
    """Sum of ``value`` over the rows of a key up to the current one.

    The rows are ordered by ``parts[-1]`` and then ``order``. ``parts`` lists leading
    columns of that order from coarse to fine, each list with the columns of the one
    before it; each level is carried over from the totals of the level above. Without
    parts this is a plain window. ``upto=-1`` leaves the current row out.
    """
    if not parts:
        window = Window.partitionBy(*keys).orderBy(*ascending(order))
        frame = window.rowsBetween(Window.unboundedPreceding, upto)
        return df.withColumn(out, F.sum(value).over(frame))
    *coarser, part = parts
    group = [*keys, *part]
    totals = df.groupBy(*group).agg(F.sum(value).alias("_add"))
    carried = running_sum(totals, keys, part, "_add", "_sum", coarser, upto=-1).select(
        *group, F.col("_sum").alias("_add"), F.lit(0).alias("_own")
    )
    rows = df.withColumn("_add", F.col(value)).withColumn("_own", F.lit(1))
    window = Window.partitionBy(*group).orderBy(*ascending(["_own", *order]))
    frame = window.rowsBetween(Window.unboundedPreceding, upto)
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn(out, F.sum("_add").over(frame))
        .filter(F.col("_own") == 1)
        .drop("_add", "_own")
    )


def ranged_running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str
) -> DataFrame:
    """As ``running_sum``, by ranges of rows instead of values of columns.

    The rows of all keys are sorted into ranges of about equal size. A range sums its own
    rows; what came before it in the key is the exclusive sum over the totals of earlier
    ranges, handed on as one row. So even a single day of one key, or rows that are equal in
    everything, are worked on by as many tasks as their number calls for.
    """
    cut = ranged(df, [*keys, *order])
    return running_sum(cut, keys, [*order, TIE], value, out, [[RANGE]]).drop(RANGE, TIE)


def rolling_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    rows: int,
    parts: Sequence[Sequence[str]] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Sum of ``value`` over the current row of a key and the ``rows - 1`` before it.

    Rows are numbered along the series and cut into blocks of ``block_rows``; the last
    ``rows - 1`` of a block go to the next one too, as what its first rows look back on.
    """
    back = rows - 1
    if block_rows < rows:
        raise ValueError("a block must hold more rows than the sum looks back on")
    numbered = running_sum(df.withColumn("_one", F.lit(1)), keys, order, "_one", "_pos", parts)
    at = F.col("_pos") - 1
    home = F.floor(at / F.lit(block_rows)).cast("long")
    looked_back_on = at % block_rows >= block_rows - back
    window = Window.partitionBy(*keys, "_block").orderBy("_pos").rowsBetween(-back, 0)
    return (
        numbered.withColumn("_home", home)
        .withColumn(
            "_block",
            F.explode(
                F.when(looked_back_on, F.array(F.col("_home"), F.col("_home") + 1)).otherwise(
                    F.array("_home")
                )
            ),
        )
        .withColumn(out, F.sum(value).over(window))
        .filter(F.col("_block") == F.col("_home"))
        .drop("_one", "_pos", "_home", "_block")
    )


def rolling_7_rows(daily: DataFrame, rows: int = 7, by_ranges: bool = False) -> DataFrame:
    """Sum of the last 7 sales rows of a region, chain name and product group.

    Rows, not days: days without sales are not rows. Chains that share a name are one
    series, ordered within a day by chain_id. ``by_ranges`` also splits days that very many
    chains share.
    """
    parts, order = [["date"]], ["chain_id"]
    if by_ranges:
        daily = ranged(daily, [*SERIES, "date", "chain_id"])
        parts, order = [[RANGE]], ["date", "chain_id", TIE]
    summed = rolling_sum(
        daily, SERIES, order, "actual_qty", "rolling_7d_actual_qty", rows, parts
    )
    return _series_columns(summed, "rolling_7d_actual_qty")


def rolling_7_days(daily: DataFrame, days: int = 7) -> DataFrame:
    """Sum of the last 7 calendar days of a region, chain name and product group.

    Summed from one total per day, so the window holds a row per day of a series
    however many chains share its name; each day's sum then goes to the day's rows as
    one more row at their head. Rows without a date form a day of their own.
    """
    per_day = daily.groupBy(*SERIES, "date").agg(F.sum("actual_qty").alias("_day"))
    last_days = (
        Window.partitionBy(*SERIES)
        .orderBy(F.unix_date("date").asc_nulls_last())
        .rangeBetween(-(days - 1), 0)
    )
    sums = per_day.select(
        *SERIES, "date", F.sum("_day").over(last_days).alias("_sum"), F.lit(0).alias("_own")
    )
    so_far = (
        Window.partitionBy(*SERIES, "date")
        .orderBy("_own")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = (
        daily.withColumn("_own", F.lit(1))
        .unionByName(sums, allowMissingColumns=True)
        .withColumn("rolling_7d_actual_qty", F.max("_sum").over(so_far))
        .filter(F.col("_own") == 1)
    )
    return _series_columns(summed, "rolling_7d_actual_qty")


def month_to_date(
    daily: DataFrame, first: str | None = None, last: str | None = None, by_ranges: bool = False
) -> DataFrame:
    """Sum since the first of the month, per region, chain name and product group.

    ``first`` and ``last`` bound the days wanted (ISO dates, inclusive). A sum depends on
    its own month only, so the input is cut to the months concerned before the shuffle.
    ``by_ranges`` also splits days that very many chains share.
    """
    if first is not None:
        daily = daily.filter(F.col("date") >= F.trunc(F.lit(first).cast("date"), "month"))
    if last is not None:
        daily = daily.filter(F.col("date") <= F.lit(last).cast("date"))
    keys, of_month = [*SERIES, "_month"], daily.withColumn("_month", F.trunc("date", "month"))
    if by_ranges:
        summed = ranged_running_sum(
            of_month, keys, ["date", "chain_id"], "actual_qty", "mtd_actual_qty"
        )
    else:
        summed = running_sum(
            of_month, keys, ["chain_id"], "actual_qty", "mtd_actual_qty", [["date"]]
        )
    if first is not None:
        summed = summed.filter(F.col("date") >= F.lit(first).cast("date"))
    return _series_columns(summed, "mtd_actual_qty")


def _series_columns(df: DataFrame, measure: str) -> DataFrame:
    return df.select("date", *SERIES, "actual_qty", F.col(measure).cast(TOTAL).alias(measure))
