"""The queries by name, each ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.numbers import round_double
from salesmart.operators import checks, links, marts, samples, series, staging, stock
from salesmart.plans.layers import REGION, Layers
from salesmart.sinks.warehouse import row_counts

Query = Callable[[SparkSession, str], DataFrame]

# Doubles that are sums of shares agree between engines up to the order of summation.
SUM_PLACES = 6


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles: two engines give sums different decimal types."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def rounded(df: DataFrame, *columns: str, places: int = SUM_PLACES) -> DataFrame:
    return df.withColumns(
        {c: round_double(F.col(c).cast("double"), places) for c in columns}
    )


def _plan_totals(layers: Layers, daily: DataFrame) -> DataFrame:
    return rounded(
        checks.plan_month_totals(layers.stg_plan, daily), "sum_daily_plan", "diff", places=4
    )


LAYER_QUERIES: dict[str, Callable[[Layers], DataFrame]] = {
    # staging
    "stg_sales": lambda y: y.stg_sales,
    "stg_sku_links": lambda y: y.stg_sku_links,
    "stg_plan": lambda y: y.stg_plan,
    "stg_stock_movements": lambda y: y.stg_stock_movements,
    "dup_documents": lambda y: checks.duplicate_doc_ids(y.raw_quantities),
    "dup_documents_quarantine": lambda y: staging.clean_sales(
        staging.duplicate_documents(y.raw_sales)
    ),
    "sku_replace_asof": lambda y: y.stg_sales_asof.select("doc_id", "date", "sku_id"),
    "sales_with_catalog": lambda y: marts.with_catalog(
        y.stg_quantities.select("doc_id", "sku_id", "qty"), y.catalog
    ),
    # plan spread over days
    "plan_daily": lambda y: rounded(y.stg_plan_daily, "plan_qty"),
    "plan_daily_exact": lambda y: rounded(y.stg_plan_daily_exact, "plan_qty"),
    "plan_daily_weekly_norm": lambda y: rounded(y.stg_plan_daily_by_week, "plan_qty"),
    # daily totals
    "sales_daily": lambda y: y.sales_daily,
    "plan_daily_agg": lambda y: rounded(y.plan_daily_agg, "plan_qty"),
    # plan against actual
    "mart_sales_plan_daily": lambda y: rounded(y.mart_sales_plan_daily, "plan_qty", "delta"),
    "mart_sales_plan_named": lambda y: rounded(y.mart_sales_plan_named, "plan_qty", "delta"),
    "mart_summary": lambda y: rounded(
        marts.mart_summary(y.mart_sales_plan_daily), "total_plan", places=3
    ),
    "mart_sample": lambda y: rounded(
        samples.mart_sample(y.mart_sales_plan_daily), "plan_qty", "delta"
    ),
    # last operation
    "last_customer_operation": lambda y: y.mart_last_customer_operation,
    "last_operation_sample": lambda y: samples.last_operation_sample(
        y.mart_last_customer_operation
    ),
    # series
    "rolling_7_rows": lambda y: y.mart_rolling_7d,
    "rolling_7_rows_by_ranges": lambda y: series.rolling_7_rows(y.sales_daily, by_ranges=True),
    "rolling_7_days": lambda y: series.rolling_7_days(y.sales_daily),
    "rolling_region_top5": lambda y: samples.region_sample(y.mart_rolling_7d, REGION),
    "mtd": lambda y: y.mart_mtd,
    "mtd_by_ranges": lambda y: series.month_to_date(y.sales_daily, by_ranges=True),
    "mtd_region_top5": lambda y: samples.region_sample(y.mart_mtd, REGION),
    "mtd_first_week_region": lambda y: series.month_to_date(
        y.sales_daily, "1997-01-01", "1997-01-07"
    ).filter(F.col("region") == REGION),
    # stock
    "stock_per_movement": lambda y: y.mart_stock_daily,
    "stock_per_movement_by_ranges": lambda y: stock.stock_per_movement(
        y.stg_stock_movements, by_ranges=True
    ),
    "stock_end_of_day": lambda y: stock.stock_end_of_day(y.stg_stock_movements),
    "stock_sample": lambda y: samples.stock_sample(y.mart_stock_daily),
    # checks
    "plan_month_totals": lambda y: _plan_totals(y, y.stg_plan_daily),
    "check_plan_sum": lambda y: rounded(
        checks.plan_sum_mismatches(y.stg_plan, y.stg_plan_daily), "sum_daily_plan", "diff", places=4
    ),
    "plan_days_of_months": lambda y: checks.plan_coverage(
        y.stg_plan, y.stg_plan_daily.filter(F.dayofmonth("date") != 31)
    ),
    "check_plan_days": lambda y: checks.plan_coverage(y.stg_plan, y.stg_plan_daily),
    "check_plan_sum_weekly_norm": lambda y: rounded(
        checks.plan_sum_mismatches(y.stg_plan, y.stg_plan_daily_by_week),
        "sum_daily_plan",
        "diff",
        places=4,
    ),
    "check_plan_sum_range": lambda y: checks.plan_days_in_range(y.stg_plan, y.stg_plan_daily),
    "check_old_sku": lambda y: checks.old_sku_count(y.stg_quantities, y.stg_sku_links),
    "old_skus_in_raw": lambda y: checks.old_skus(
        staging.clean_sales(y.raw_quantities), y.stg_sku_links
    ),
    "old_skus_left_asof": lambda y: checks.old_skus(y.stg_sales_asof, y.stg_sku_link_history),
    "link_overlaps": lambda y: links.overlapping_links(y.stg_sku_link_history),
    "link_chains": lambda y: links.link_chains(y.stg_sku_supersessions),
    "check_mart_keys": lambda y: checks.duplicate_mart_keys(y.mart_sales_plan_daily),
    "check_null_profile": lambda y: checks.null_profile(y.mart_sales_plan_daily),
    "check_returns": lambda y: checks.returns_profile(y.stg_quantities),
    "check_negative_stock": lambda y: checks.negative_stock(y.mart_stock_daily),
    "check_mtd_first_day": lambda y: checks.mtd_first_day_breaks(y.mart_mtd),
    "check_report": lambda y: y.stored_once().check_report,
    "layer_counts": lambda y: row_counts(y.stored_once(customers=True).counted()),
}


def queries() -> dict[str, Query]:
    def bound(build: Callable[[Layers], DataFrame]) -> Query:
        return lambda spark, sf_dir: comparable(build(Layers(spark, sf_dir)))

    return {name: bound(build) for name, build in LAYER_QUERIES.items()}
