"""Stock on hand and its value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.ordering import ascending
from salesmart.operators.series import ranged_running_sum, running_sum
from salesmart.schemas import MART_STOCK, TOTAL

STOCK_KEYS = ["warehouse_id", "sku_id"]
# Movements of one day: in the order of their columns, incoming before outgoing.
WITHIN_DAY = ["operation_type", "qty", "unit_cost_byn", "warehouse_name"]
# Movements of a product in a warehouse that one task may sort.
MOST_TOGETHER = 1 << 20


def stock_change() -> Column:
    """Income adds, outcome takes away, any other operation leaves the stock as it is."""
    operation = F.col("operation_type")
    return (
        F.when(operation == "income", F.col("qty"))
        .when(operation == "outcome", -F.col("qty"))
        .otherwise(F.lit(0))
    )


def stock_per_movement(
    movements: DataFrame,
    within_day: Sequence[str] = WITHIN_DAY,
    parts: Sequence[Sequence[str]] = (("date",),),
    by_ranges: bool = False,
) -> DataFrame:
    """Balance after each movement, valued at that movement's unit cost.

    A product that moves very often in one warehouse is worked on day by day; give
    finer ``parts`` where single days are that large, none where no product moves so often. ``by_ranges`` splits the movements by
    their number instead, also those of one day, at the price of storing them once.
    """
    changes = movements.withColumn("_change", stock_change())
    if by_ranges:
        order = ["date", *within_day]
        balance = ranged_running_sum(changes, STOCK_KEYS, order, "_change", "stock_qty")
    else:
        order = within_day if parts else ["date", *within_day]
        balance = running_sum(changes, STOCK_KEYS, order, "_change", "stock_qty", parts)
    return _valued(balance)


def parts_needed(movements: DataFrame, most: int = MOST_TOGETHER) -> Sequence[Sequence[str]]:
    """The ``parts`` of ``stock_per_movement``: none where no product moves over ``most`` times.

    Products that move on a day or two each would have as many carried rows as movements. This counts
    the movements at once; the driver gets one number.
    """
    counts = movements.groupBy(*STOCK_KEYS).agg(F.count(F.lit(1)).alias("_n"))
    largest = counts.agg(F.max("_n").alias("_n")).first()["_n"]
    return (("date",),) if (largest or 0) > most else ()


def stock_end_of_day(movements: DataFrame, within_day: Sequence[str] = WITHIN_DAY) -> DataFrame:
    """Balance at the end of each day with movements, valued at the day's last cost.

    The movements of a day are summed before the window, which then has at most one row
    per calendar day of a product in a warehouse.
    """
    last = F.max(F.struct(*within_day))
    per_day = movements.groupBy(*STOCK_KEYS, "date").agg(
        F.sum(stock_change()).alias("_change"), last.alias("_last")
    )
    window = Window.partitionBy(*STOCK_KEYS).orderBy(*ascending(["date"]))
    frame = window.rowsBetween(Window.unboundedPreceding, 0)
    balance = per_day.withColumn("stock_qty", F.sum("_change").over(frame)).select(
        "*", "_last.warehouse_name", "_last.unit_cost_byn"
    )
    return _valued(balance)


def _valued(balance: DataFrame) -> DataFrame:
    """Drop empty stock and value the rest."""
    value = F.round(F.col("stock_qty") * F.col("unit_cost_byn"), 2)
    return (
        balance.withColumn("stock_qty", F.col("stock_qty").cast(TOTAL))
        .withColumn("stock_value_byn", value.cast(TOTAL))
        .filter(F.col("stock_qty") != 0)
        .select(*MART_STOCK.names)
    )
