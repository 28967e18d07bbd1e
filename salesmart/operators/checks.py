"""Data-quality checks, each a DataFrame of offending rows or of counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.numbers import exact_sum, round_double
from salesmart.operators.facts import MART_KEYS
from salesmart.operators.series import SERIES
from salesmart.schemas import TOTAL

PLAN_KEYS = ["chain_id", "region", "product_group"]
# A daily plan kept in 32-bit floats misses the month by less than this.
PLAN_TOLERANCE = 0.01


def duplicate_doc_ids(raw_sales: DataFrame) -> DataFrame:
    """Documents that occur more than once, with their number of rows."""
    return (
        raw_sales.groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("dup_count"))
        .filter(F.col("dup_count") > 1)
    )


def plan_month_totals(plan: DataFrame, daily_plan: DataFrame) -> DataFrame:
    """Monthly plan beside the sum of its days, per plan month and keys.

    The days are summed per month before the join, which then is one to one on hashed
    keys; plan rows that repeat a key count once each, as in a join with the days.
    """
    month = F.trunc("date", "month").alias("plan_month")
    per_month = daily_plan.groupBy(month, *PLAN_KEYS).agg(
        exact_sum(F.col("plan_qty")).alias("_daily")
    )
    return (
        plan.join(per_month, ["plan_month", *PLAN_KEYS])
        .groupBy("plan_month", *PLAN_KEYS, F.col("plan_qty").alias("monthly_plan"))
        .agg(exact_sum(F.col("_daily")).alias("sum_daily_plan"))
        .withColumn("monthly_plan", F.col("monthly_plan").cast("double"))
        .withColumn("diff", F.col("sum_daily_plan") - F.col("monthly_plan"))
    )


def plan_sum_mismatches(
    plan: DataFrame, daily_plan: DataFrame, tolerance: float = PLAN_TOLERANCE
) -> DataFrame:
    """Plan rows whose days do not add up to the month."""
    return plan_month_totals(plan, daily_plan).filter(F.abs("diff") > tolerance)


def plan_days_in_range(plan: DataFrame, daily_plan: DataFrame) -> DataFrame:
    """Sum and number of planned days in [plan_month, plan_month + 1 month).

    The range is asked as such; the month of the day is added as an equality, so that a
    plan row meets the days of its own month instead of every day of its series.
    """
    p = plan.select("plan_month", *PLAN_KEYS, F.col("plan_qty").alias("monthly_plan")).alias("p")
    d = daily_plan.alias("d")
    in_range = (F.col("d.date") >= F.col("p.plan_month")) & (
        F.col("d.date") < F.add_months("p.plan_month", 1)
    )
    same_month = F.trunc("d.date", "month") == F.trunc("p.plan_month", "month")
    same_keys = [F.col(f"d.{k}") == F.col(f"p.{k}") for k in PLAN_KEYS]
    return (
        p.join(d, [*same_keys, same_month, in_range])
        .groupBy(*[F.col(f"p.{c}") for c in (*PLAN_KEYS, "plan_month", "monthly_plan")])
        .agg(
            round_double(exact_sum(F.col("d.plan_qty")), 2).alias("sum_daily"),
            F.count("d.date").alias("days_in_plan"),
        )
        .withColumn("monthly_plan", F.col("monthly_plan").cast("double"))
        .withColumn("days_in_month", F.dayofmonth(F.last_day("plan_month")).cast("long"))
    )


def plan_coverage(plan: DataFrame, daily_plan: DataFrame) -> DataFrame:
    """Months and keys whose days are not those of the month, seen from both sides.

    ``n_plan_rows`` and ``n_day_rows`` are 0 where one side has no row at all: a plan that
    lost all its days, or days without a plan. ``n_expected`` is the days that the plan
    rows should have given. NULL keys are keys like others.
    """
    month = F.trunc("date", "month").alias("plan_month")
    given = plan.groupBy("plan_month", *PLAN_KEYS).agg(F.count(F.lit(1)).alias("_plans"))
    spread = daily_plan.groupBy(month, *PLAN_KEYS).agg(F.count(F.lit(1)).alias("_days"))
    # Sides of unique keys are put one under the other: no join, and NULL keys meet.
    both = given.withColumn("_days", F.lit(0).cast("long")).unionByName(
        spread.withColumn("_plans", F.lit(0).cast("long"))
    )
    expected = F.col("n_plan_rows") * F.coalesce(F.dayofmonth(F.last_day("plan_month")), F.lit(0))
    return (
        both.groupBy("plan_month", *PLAN_KEYS)
        .agg(F.sum("_plans").alias("n_plan_rows"), F.sum("_days").alias("n_day_rows"))
        .withColumn("n_expected", expected.cast("long"))
        .filter((F.col("n_day_rows") != F.col("n_expected")) | (F.col("n_plan_rows") == 0))
    )


def old_skus(sales: DataFrame, links: DataFrame) -> DataFrame:
    """Distinct old product codes that occur in the sales."""
    old = links.select(F.col("old_sku_id").alias("sku_id"))
    return sales.select("sku_id").join(old, "sku_id", "left_semi").distinct()


def old_sku_count(sales: DataFrame, links: DataFrame) -> DataFrame:
    old = links.select(F.col("old_sku_id").alias("sku_id"))
    return (
        sales.select("sku_id")
        .join(old, "sku_id", "left_semi")
        .agg(F.countDistinct("sku_id").alias("n_old_skus"))
    )


def duplicate_mart_keys(mart: DataFrame) -> DataFrame:
    """Mart keys with more than one row."""
    return (
        mart.groupBy(*MART_KEYS)
        .agg(F.count(F.lit(1)).alias("dup_count"))
        .filter(F.col("dup_count") > 1)
    )


def null_profile(mart: DataFrame) -> DataFrame:
    """Row count, NULLs per key column, and rows with a NULL in any of them."""
    any_null = F.lit(False)
    for key in MART_KEYS:
        any_null = any_null | F.col(key).isNull()
    return mart.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in MART_KEYS],
        F.count_if(any_null).alias("null_keys"),
    )


def returns_profile(sales: DataFrame) -> DataFrame:
    """Number and volume of returns in the staged sales."""
    return sales.filter(F.col("qty") < 0).agg(
        F.count(F.lit(1)).alias("n_returns"),
        F.round(F.sum("qty"), 0).cast(TOTAL).alias("returned_qty"),
    )


def negative_stock(stock: DataFrame) -> DataFrame:
    return stock.filter(F.col("stock_qty") < 0)


def mtd_first_day_breaks(mtd: DataFrame) -> DataFrame:
    """Months whose month-to-date sum does not start at the first day's own quantity.

    Chains that share a name have several rows on that day, of which one must start the
    sum.
    """
    gap = F.abs(
        F.coalesce("mtd_actual_qty", F.lit(0)) - F.coalesce("actual_qty", F.lit(0))
    ).alias("gap")
    return (
        mtd.groupBy(*SERIES, F.trunc("date", "month").alias("month"))
        .agg(F.min(F.struct("date", gap)).alias("_first"))
        .select(*SERIES, "month", F.col("_first.date").alias("date"), F.col("_first.gap"))
        .filter(F.col("gap") != 0)
    )


def check_report(
    raw_sales: DataFrame,
    sales: DataFrame,
    links: DataFrame,
    plan: DataFrame,
    daily_plan: DataFrame,
    mart: DataFrame,
    mtd: DataFrame,
    stock: DataFrame | None = None,
    plan_days: bool = False,
) -> DataFrame:
    """``(check, n_bad, passed)``, one row per check, evaluated in one job.

    ``plan_days`` adds the check of the plan's days from both sides, as the batch and the query do.

    Repeated documents and returns are reported, not failed: the first are left out of
    staging, the second are wanted.
    """

    def rows(name: str, df: DataFrame, informative: bool = False) -> DataFrame:
        n_bad = F.count(F.lit(1))
        passed = F.lit(True) if informative else n_bad == 0
        return df.agg(n_bad.alias("n_bad"), passed.alias("passed")).select(
            F.lit(name).alias("check"), "n_bad", "passed"
        )

    def figure(name: str, df: DataFrame, column: str, informative: bool = False) -> DataFrame:
        passed = F.lit(True) if informative else F.col(column) == 0
        return df.select(
            F.lit(name).alias("check"), F.col(column).alias("n_bad"), passed.alias("passed")
        )

    checks = [
        rows("duplicate_documents", duplicate_doc_ids(raw_sales), informative=True),
        rows("plan_sum", plan_sum_mismatches(plan, daily_plan)),
        figure("old_sku", old_sku_count(sales, links), "n_old_skus"),
        rows("duplicate_mart_keys", duplicate_mart_keys(mart)),
        figure("null_mart_keys", null_profile(mart), "null_keys"),
        figure("returns", returns_profile(sales), "n_returns", informative=True),
        rows("mtd_first_day", mtd_first_day_breaks(mtd)),
    ]
    if plan_days:
        checks.append(rows("plan_days", plan_coverage(plan, daily_plan)))
    if stock is not None:
        checks.append(rows("negative_stock", negative_stock(stock)))
    report = checks[0]
    for check in checks[1:]:
        report = report.unionByName(check)
    return report


class ChecksFailed(RuntimeError):
    """A check that must hold does not."""


def require_passed(report: DataFrame, tolerated: Sequence[str] = ()) -> None:
    """Fail the job where a check failed, apart from the tolerated ones."""
    failed = report.filter(~F.col("passed") & ~F.col("check").isin(*tolerated))
    bad = failed.orderBy("check").collect()
    if bad:
        raise ChecksFailed(", ".join(f"{row.check}: {row.n_bad}" for row in bad))
