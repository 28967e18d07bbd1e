"""Plan against actual, last operation of a customer, catalogue names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.numbers import percent_of
from salesmart.functions.ordering import descending
from salesmart.operators.facts import MART_KEYS
from salesmart.schemas import MART_SALES_PLAN, TOTAL


def sales_plan_daily(
    daily_sales: DataFrame, daily_plan: DataFrame, fill_chain_name: bool = False
) -> DataFrame:
    """Actual and plan side by side per day, region, chain and product group.

    A full join on plain equality: days with only one of the two keep their row, and
    keys that are NULL never match. Both sides come aggregated, so the plan has one row
    per key; the sales have one per chain name, and a chain with two names on a day
    repeats its plan (the duplicate-key check reports that).

    A row without sales has an empty chain name, or with ``fill_chain_name`` the name
    ``daily_plan`` carries.
    """
    s, p = daily_sales.alias("s"), daily_plan.alias("p")
    same_key = [F.col(f"s.{k}") == F.col(f"p.{k}") for k in MART_KEYS]
    keys = {k: F.coalesce(f"s.{k}", f"p.{k}") for k in MART_KEYS}
    names = ["s.chain_name", *(["p.chain_name"] if fill_chain_name else [])]
    columns = {
        **keys,
        "chain_name": F.coalesce(*names, F.lit("")),
        "actual_qty": F.coalesce("s.actual_qty", F.lit(0)).cast(TOTAL),
        "plan_qty": F.coalesce("p.plan_qty", F.lit(0.0)),
    }
    joined = s.join(p, same_key, "full_outer").select(*[c.alias(n) for n, c in columns.items()])
    return (
        joined.withColumn("delta", F.col("actual_qty").cast("double") - F.col("plan_qty"))
        .withColumn("completion_pct", percent_of(F.col("actual_qty"), F.col("plan_qty")))
        .select(*MART_SALES_PLAN.names)
    )


def last_customer_operation(sales: DataFrame) -> DataFrame:
    """The latest document of each customer, by date and then doc_id.

    As in de-duplication, ``= 1`` on the rank keeps one row per customer and task
    before the shuffle.
    """
    order = ["date", "doc_id", "sku_id", "qty", "revenue_byn"]
    window = Window.partitionBy("customer_id").orderBy(*descending(order))
    return (
        sales.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .select(
            "customer_id",
            *[
                F.col(c).alias(f"last_{c}")
                for c in ("doc_id", "date", "sku_id", "qty", "revenue_byn")
            ],
        )
    )


def with_catalog(sales: DataFrame, catalog: DataFrame) -> DataFrame:
    """Sales with the product's name and base price, NULL for unknown products."""
    names = catalog.select("sku_id", "sku_name", "base_price_byn")
    return sales.join(names, "sku_id", "left").select(
        *sales.columns, "sku_name", "base_price_byn"
    )


def mart_summary(mart: DataFrame) -> DataFrame:
    """Period, totals and row count of the plan-against-actual mart."""
    return mart.agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.sum("actual_qty").cast(TOTAL).alias("total_actual"),
        F.sum("plan_qty").alias("total_plan"),
        F.count(F.lit(1)).alias("n_rows"),
    )
