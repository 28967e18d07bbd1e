"""Daily totals of sales and plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.numbers import exact_sum
from salesmart.schemas import TOTAL

MART_KEYS = ["date", "region", "chain_id", "product_group"]


def sales_daily(sales: DataFrame) -> DataFrame:
    """Quantity per day, region, chain, chain name and product group."""
    return sales.groupBy("date", "region", "chain_id", "chain_name", "product_group").agg(
        F.sum("qty").cast(TOTAL).alias("actual_qty")
    )


def plan_daily_agg(daily_plan: DataFrame, with_chain_name: bool = False) -> DataFrame:
    """Plan per day, region, chain and product group; repeated plan rows add up.

    The sum is the same to the last bit however the rows are dealt out.
    """
    names = [F.min("chain_name").alias("chain_name")] if with_chain_name else []
    return daily_plan.groupBy(*MART_KEYS).agg(
        exact_sum(F.col("plan_qty")).alias("plan_qty"), *names
    )
