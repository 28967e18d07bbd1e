"""Every layer over the star-schema stand-ins, as one lazy plan each unless ``once`` is set."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from salesmart.operators import checks, facts, marts, plan, series, staging, stock
from salesmart.sinks import scratch
from salesmart.sources import starschema

# The region of the sample queries.
REGION = "ASIA"


@dataclass
class Layers:
    """Raw, staging and mart tables of one directory; nothing runs until asked for.

    With ``once`` what several layers read is stored as soon as one of them is asked for: the
    joined lines, the de-duplicated sales, the monthly plan and the daily totals. That is for what
    covers many layers in one plan, each of which would compute those anew. With ``customers`` too
    the sales are de-duplicated only with their customers, whose columns come last in the document order.
    """

    spark: SparkSession
    sf_dir: str
    once: bool = False
    customers: bool = False

    def stored_once(self, customers: bool = False) -> Layers:
        return replace(self, once=True, customers=customers)

    def _shared(self, df: DataFrame, name: str) -> DataFrame:
        return scratch.stored(df, name) if self.once else df

    @cached_property
    def lines(self) -> DataFrame | None:
        """The line items with part and supplier, where they are stored."""
        return scratch.stored(starschema.lines(self.spark, self.sf_dir), "lines") if self.once else None

    # raw ---------------------------------------------------------------------------
    @cached_property
    def raw_sales(self) -> DataFrame:
        return starschema.sales(self.spark, self.sf_dir, lines=self.lines)

    @cached_property
    def raw_quantities(self) -> DataFrame:
        """Sales without the last columns of the document order: customer and revenue."""
        sold = starschema.sales(self.spark, self.sf_dir, with_customer=False, lines=self.lines)
        return sold.drop("revenue_byn")

    @cached_property
    def raw_plan(self) -> DataFrame:
        return self._shared(starschema.plan(self.spark, self.sf_dir, self.lines), "plan")

    @cached_property
    def raw_sku_links(self) -> DataFrame:
        return starschema.sku_links(self.spark, self.sf_dir)

    @cached_property
    def raw_stock_movements(self) -> DataFrame:
        return starschema.stock_movements(self.spark, self.sf_dir, self.lines)

    @cached_property
    def catalog(self) -> DataFrame:
        return starschema.catalog(self.spark, self.sf_dir)

    # staging -----------------------------------------------------------------------
    @cached_property
    def stg_sku_links(self) -> DataFrame:
        return staging.stg_sku_links(self.raw_sku_links)

    @cached_property
    def stg_sku_link_history(self) -> DataFrame:
        return staging.stg_sku_links(starschema.sku_link_history(self.spark, self.sf_dir))

    @cached_property
    def stg_sku_supersessions(self) -> DataFrame:
        return staging.stg_sku_links(starschema.sku_supersessions(self.spark, self.sf_dir))

    @cached_property
    def stg_sales(self) -> DataFrame:
        return self._shared(staging.stg_sales(self.raw_sales, self.stg_sku_links), "sales")

    @cached_property
    def stg_quantities(self) -> DataFrame:
        if self.once and self.customers:
            return self.stg_sales.drop("customer_id", "revenue_byn")
        return self._shared(staging.stg_sales(self.raw_quantities, self.stg_sku_links), "sales")

    @cached_property
    def stg_sales_asof(self) -> DataFrame:
        return staging.replace_sku_asof(
            staging.clean_sales(staging.first_documents(self.raw_quantities)),
            self.stg_sku_link_history,
            staging.clean_sales(self.raw_quantities),
        )

    @cached_property
    def stg_plan(self) -> DataFrame:
        return staging.stg_plan(self.raw_plan)

    @cached_property
    def stg_plan_daily(self) -> DataFrame:
        return plan.allocate_monthly(self.stg_plan, storage="float")

    @cached_property
    def stg_plan_daily_exact(self) -> DataFrame:
        return plan.allocate_monthly(self.stg_plan)

    @cached_property
    def stg_plan_daily_by_week(self) -> DataFrame:
        return plan.allocate_monthly(self.stg_plan, normalise="week", storage="float")

    @cached_property
    def stg_stock_movements(self) -> DataFrame:
        return staging.stg_stock_movements(self.raw_stock_movements)

    # daily totals ------------------------------------------------------------------
    @cached_property
    def sales_daily(self) -> DataFrame:
        return self._shared(facts.sales_daily(self.stg_quantities), "daily")

    @cached_property
    def plan_daily_agg(self) -> DataFrame:
        return facts.plan_daily_agg(self.stg_plan_daily)

    # marts -------------------------------------------------------------------------
    @cached_property
    def mart_sales_plan_daily(self) -> DataFrame:
        return marts.sales_plan_daily(self.sales_daily, self.plan_daily_agg)

    @cached_property
    def mart_sales_plan_named(self) -> DataFrame:
        named = staging.stg_plan(self.raw_plan, with_chain_name=True)
        daily = plan.allocate_monthly(named, storage="float", keep=["chain_name"])
        return marts.sales_plan_daily(
            self.sales_daily,
            facts.plan_daily_agg(daily, with_chain_name=True),
            fill_chain_name=True,
        )

    @cached_property
    def mart_last_customer_operation(self) -> DataFrame:
        return marts.last_customer_operation(self.stg_sales)

    @cached_property
    def mart_rolling_7d(self) -> DataFrame:
        return series.rolling_7_rows(self.sales_daily)

    @cached_property
    def mart_mtd(self) -> DataFrame:
        return series.month_to_date(self.sales_daily)

    @cached_property
    def mart_stock_daily(self) -> DataFrame:
        movements = self.stg_stock_movements
        if not self.once:
            return stock.stock_per_movement(movements)
        return stock.stock_per_movement(movements, parts=stock.parts_needed(movements))

    # report ------------------------------------------------------------------------
    @cached_property
    def check_report(self) -> DataFrame:
        return checks.check_report(
            raw_sales=self.raw_quantities,
            sales=self.stg_quantities,
            links=self.stg_sku_links,
            plan=self.stg_plan,
            daily_plan=self.stg_plan_daily,
            mart=self.mart_sales_plan_daily,
            mtd=self.mart_mtd,
            stock=self.mart_stock_daily,
            plan_days=True,
        )

    def counted(self) -> dict[str, tuple[str, DataFrame]]:
        """What the row-count audit covers: table to layer and content."""
        return {
            "raw_sales": ("raw", self.raw_quantities),
            "raw_plan": ("raw", self.raw_plan),
            "raw_sku_links": ("raw", self.raw_sku_links),
            "raw_stock_movements": ("raw", self.raw_stock_movements),
            "stg_sales": ("stg", self.stg_quantities),
            "stg_plan_daily": ("stg", self.stg_plan_daily),
            "mart_sales_plan_daily": ("mart", self.mart_sales_plan_daily),
            "mart_last_customer_operation": ("mart", self.mart_last_customer_operation),
            "mart_rolling_7d": ("mart", self.mart_rolling_7d),
            "mart_mtd": ("mart", self.mart_mtd),
            "mart_stock_daily": ("mart", self.mart_stock_daily),
        }
