"""Short ordered extracts of the marts, for display."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.ordering import ascending


def top(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in the given order, without sorting the rest."""
    return df.orderBy(*ascending(order)).limit(n)


def mart_sample(mart: DataFrame, n: int = 10) -> DataFrame:
    """Rows with something sold or planned."""
    active = mart.filter((F.col("actual_qty") > 0) | (F.col("plan_qty") > 0))
    order = ["date", "region", "chain_id", "product_group", "chain_name"]
    return top(active, order, n).drop("chain_name")


def last_operation_sample(last_operations: DataFrame, n: int = 5) -> DataFrame:
    return top(last_operations, ["customer_id"], n)


def region_sample(series: DataFrame, region: str, n: int = 5) -> DataFrame:
    """First rows of one region of a rolling or month-to-date mart.

    The region is a partition key of both windows, so its filter reaches the scan.
    """
    measures = series.columns[-2:]
    of_region = series.filter(F.col("region") == region)
    return top(of_region, ["date", "chain_name", "product_group", *measures], n)


def stock_sample(stock: DataFrame, n: int = 5) -> DataFrame:
    order = ["warehouse_id", "sku_id", "date", "stock_qty", "stock_value_byn"]
    return top(stock, order, n)
