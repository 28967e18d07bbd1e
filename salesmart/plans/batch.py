"""The whole batch: delimited files in, stored layers and a check report out."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from concurrent.futures import Future
from dataclasses import dataclass
from typing import Any

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart import schemas
from salesmart.operators import checks, facts, marts, plan, series, staging, stock
from salesmart.session import require, size_shuffles
from salesmart.sinks.warehouse import Warehouse
from salesmart.sources import files

log = logging.getLogger(__name__)

# Where rows of a raw table go that do not fit its schema.
QUARANTINE = {
    "raw_sales_1c": "bad_sales",
    "raw_plan": "bad_plan",
    "raw_sku_links": "bad_sku_links",
    "raw_product_catalog": "bad_product_catalog",
    "raw_stock_movements": "bad_stock_movements",
}
# Negative stock is a finding, not a fault.
TOLERATED = ("negative_stock",)

# The file names of the inputs.
SALES_FILE = "sales_1c.csv"
PLAN_FILE = "plan.csv"
SKU_LINKS_FILE = "sku_links.csv"
CATALOG_FILE = "product_catalog_optional.csv"
STOCK_FILE = "stock_movements_optional.csv"


@dataclass
class Outcome:
    """What a run leaves behind: the stored tables, their row counts and the report."""

    warehouse: Warehouse
    counts: DataFrame
    report: DataFrame


def together(*steps: Callable[[], Any]) -> list[Any]:
    """Results of steps that submit their Spark jobs side by side."""
    outcomes = [Future() for _ in steps]

    def work(step: Callable[[], Any], outcome: Future) -> None:
        try:
            outcome.set_result(step())
        except Exception as error:
            outcome.set_exception(error)

    threads = [InheritableThread(work, args=pair) for pair in zip(steps, outcomes, strict=True)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    return [outcome.result() for outcome in outcomes]


def run(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    *,
    quarantine: bool = False,
    empty_as_null: bool = False,
    sku_by_date: bool = False,
    fill_chain_name: bool = False,
    normalise: str = "month",
    plan_storage: str = "float",
    marts_by_month: bool = False,
    months: Sequence[str] | None = None,
    fail_on_checks: bool = True,
) -> Outcome:
    """Load, stage, spread the plan, build every mart, count and check.

    Each table is replaced as a whole, once its new content is complete, so a repeated run
    leaves the same tables and a stopped one the old. What
    several steps read is written once and read back, which also ends its lineage: a
    lost executor costs the tasks of one step. Tables that do not depend on one another
    are written at the same time. The optional inputs may be missing.

    ``quarantine`` puts rows of any input that do not cast, and plan rows that cannot be
    spread, into tables of their own instead of failing; ``sku_by_date`` replaces old product codes only while their link is valid;
    ``empty_as_null``, ``fill_chain_name``, ``normalise`` and ``plan_storage`` are those
    of the operators; ``marts_by_month`` partitions the daily marts by month, and ``months``
    ("2025-01") then writes only these months of them, leaving the files of all others.
    """
    require(spark)
    if months is not None and not marts_by_month:
        raise ValueError("months can be replaced where the marts are kept by month")
    warehouse = Warehouse(spark, out_dir)
    warehouse.recover()
    save = warehouse.replace

    def save_daily(name: str, df: DataFrame, order: Sequence[str]) -> DataFrame:
        if months is not None:
            return warehouse.replace_months("mart", name, df, months, "date", order)
        return save("mart", name, df, order, "date" if marts_by_month else None)

    source = in_dir.rstrip("/")

    def raw(table: str, file: str, schema: T.StructType) -> DataFrame:
        path = f"{source}/{file}"
        if not quarantine:
            return save("raw", table, files.read_csv(spark, path, schema))
        text = files.read_text_columns(spark, path, schema)
        good, bad = files.split_castable(text, schema)
        if "month" in schema.names:  # text, but of which a date is made
            first = F.concat("month", F.lit("-01")).try_cast("date")
            wrong = good.filter(F.col("month").isNotNull() & first.isNull())
            marked = wrong.select(*[F.col(f.name).cast("string") for f in schema])
            bad = bad.unionByName(marked.withColumn("bad_columns", F.array(F.lit("month"))))
            good = good.filter(F.col("month").isNull() | first.isNotNull())
        save("quarantine", QUARANTINE[table], bad)
        return save("raw", table, good)

    def optional_raw(table: str, file: str, schema: T.StructType) -> DataFrame | None:
        return files.if_present(lambda: raw(table, file, schema), f"{source}/{file}")

    def sales_input() -> DataFrame:
        size_shuffles(spark, f"{source}/{SALES_FILE}")
        return raw("raw_sales_1c", SALES_FILE, schemas.RAW_SALES)

    raw_sales, raw_plan, raw_links, raw_catalog, raw_moves = together(
        sales_input,
        lambda: raw("raw_plan", PLAN_FILE, schemas.RAW_PLAN),
        lambda: raw("raw_sku_links", SKU_LINKS_FILE, schemas.RAW_SKU_LINKS),
        lambda: optional_raw("raw_product_catalog", CATALOG_FILE, schemas.RAW_CATALOG),
        lambda: optional_raw("raw_stock_movements", STOCK_FILE, schemas.RAW_STOCK_MOVEMENTS),
    )

    def stage_sales() -> tuple[DataFrame, DataFrame, DataFrame]:
        links = save("stg", "stg_sku_links", staging.stg_sku_links(raw_links))
        once = staging.clean_sales(staging.first_documents(raw_sales), empty_as_null)
        if sku_by_date:
            asked = staging.clean_sales(raw_sales, empty_as_null)
            coded = staging.replace_sku_asof(once, links, asked)
        else:
            coded = staging.replace_sku(once, links)
        sales = save("stg", "stg_sales", coded.to(schemas.STG_SALES))
        return links, sales, save("mart", "sales_daily", facts.sales_daily(sales))

    def stage_plan() -> tuple[DataFrame, DataFrame, DataFrame]:
        names = ["chain_name"] if fill_chain_name else []
        staged = staging.stg_plan(raw_plan, bool(names))
        if quarantine:
            staged, unusable = plan.split_usable(staged, normalise)
            save("quarantine", "plan_not_spread", unusable)
        monthly = save("stg", "stg_plan_raw", staged)
        spread = plan.allocate_monthly(monthly, normalise, plan_storage, keep=names)
        daily = save("stg", "stg_plan_daily", spread)
        total = save("mart", "plan_daily_agg", facts.plan_daily_agg(daily, bool(names)))
        return monthly, daily, total

    def stock_marts() -> DataFrame | None:
        if raw_moves is None:
            return None
        moves = save("stg", "stg_stock_movements", staging.stg_stock_movements(raw_moves))
        by_product = [*stock.STOCK_KEYS, "date"]
        balance, _ = together(
            lambda: save_daily(
                "mart_stock_daily", stock.stock_per_movement(moves, by_ranges=True), by_product
            ),
            lambda: save_daily("mart_stock_end_of_day", stock.stock_end_of_day(moves), by_product),
        )
        return balance

    (links, sales, sales_daily), (monthly, daily_plan, plan_daily), stock_mart, _ = together(
        stage_sales,
        stage_plan,
        stock_marts,
        lambda: save("quarantine", "dup_docs", staging.duplicate_documents(raw_sales)),
    )

    def sales_marts() -> None:
        last = marts.last_customer_operation(sales)
        save("mart", "mart_last_customer_operation", last, ["customer_id"])
        if raw_catalog is not None:
            save("mart", "sales_with_catalog", marts.with_catalog(sales, raw_catalog))

    by_key = ["date", "region", "chain_id", "product_group"]
    by_series = [*series.SERIES, "date"]
    mart, mtd, *_ = together(
        lambda: save_daily(
            "mart_sales_plan_daily",
            marts.sales_plan_daily(sales_daily, plan_daily, fill_chain_name),
            by_key,
        ),
        lambda: save_daily("mart_mtd", series.month_to_date(sales_daily), by_series),
        lambda: save_daily("mart_rolling_7d", series.rolling_7_rows(sales_daily), by_series),
        lambda: save_daily("mart_rolling_7_days", series.rolling_7_days(sales_daily), by_series),
        sales_marts,
    )

    def check() -> DataFrame:
        report = checks.check_report(
            raw_sales, sales, links, monthly, daily_plan, mart, mtd, stock_mart, plan_days=True
        )
        return save("audit", "check_report", report)

    counts, report = together(lambda: save("audit", "layer_counts", warehouse.counts()), check)
    for row in counts.orderBy("layer", "table").collect():
        log.info("%s.%s: %d rows", row.layer, row.table, row.n_rows)
    for row in report.orderBy("check").collect():
        log.info("%s: %d, %s", row.check, row.n_bad, "passed" if row.passed else "FAILED")
    # Dated links leave old codes outside their dates.
    tolerated = [*TOLERATED, *(["old_sku"] if sku_by_date else [])]
    if fail_on_checks:
        checks.require_passed(report, tolerated)
    return Outcome(warehouse, counts, report)


def validate(
    spark: SparkSession, out_dir: str, *, tolerated: Sequence[str] = TOLERATED, fail_on_checks: bool = True
) -> DataFrame:
    """The check report over the tables that an earlier run left, without loading anything."""
    require(spark)
    warehouse = Warehouse.open(spark, out_dir)
    needed = ("raw_sales_1c", "stg_sales", "stg_sku_links", "stg_plan_raw", "stg_plan_daily")
    found = [warehouse.read(name) for name in (*needed, "mart_sales_plan_daily", "mart_mtd")]
    stocked = warehouse.read("mart_stock_daily") if "mart_stock_daily" in warehouse.tables else None
    report = checks.check_report(*found, stocked, plan_days=True)
    for row in report.orderBy("check").collect():
        log.info("%s: %d, %s", row.check, row.n_bad, "passed" if row.passed else "FAILED")
    if fail_on_checks:
        checks.require_passed(report, tolerated)
    return report
