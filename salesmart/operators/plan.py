"""Spreading a monthly plan over the days of its month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.schemas import WEIGHTS

NORMALISE = ("month", "week")
STORAGE = ("double", "float")


def _weight_on(day: Column) -> Column:
    return F.col("_weights")[F.weekday(day)]


def _totalled(plan: DataFrame, normalise: str) -> DataFrame:
    """The plan with its weights by weekday, the days of its month and their total weight."""
    weights = F.array(*[F.col(w).cast("double") for w in WEIGHTS])
    counted = F.col("_days") if normalise == "month" else F.slice("_days", 1, 7)
    total = F.aggregate(counted, F.lit(0.0), lambda so_far, day: so_far + _weight_on(day))
    return (
        plan.withColumn("_weights", weights)
        .withColumn("_days", F.sequence("plan_month", F.last_day("plan_month")))
        .withColumn("_total", total)
    )


def _unusable() -> Column:
    return F.col("plan_qty").isNull() | F.col("_total").isNull() | (F.col("_total") == 0)


def split_usable(plan: DataFrame, normalise: str = "month") -> tuple[DataFrame, DataFrame]:
    """Plan rows that can be spread, and the others with the ``reason`` why not."""
    reason = (
        F.when(F.col("plan_qty").isNull(), F.lit("no quantity"))
        .when(F.col("plan_month").isNull(), F.lit("no month"))
        .when(F.col("_total").isNull(), F.lit("a weight is missing"))
        .otherwise(F.lit("weights add up to 0"))
    )
    totalled = _totalled(plan, normalise)
    good = totalled.filter(~_unusable()).select(*plan.columns)
    return good, totalled.filter(_unusable()).select(*plan.columns, reason.alias("reason"))


def allocate_monthly(
    plan: DataFrame,
    normalise: str = "month",
    storage: str = "double",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per plan row and day of its month, weighted by the weekday.

    With ``normalise="month"`` the weights are divided by their sum over the month's
    own days, so that the days add up to ``plan_qty``; ``"week"`` divides by the sum of
    the seven weights, which adds up to about 4.3 times as much. The arithmetic is in
    doubles; ``storage="float"`` rounds each day to 32 bits as a FLOAT column does.

    Rows multiply by at most 31 without a shuffle. A missing quantity or weight, or
    weights that add up to 0, fail the job: there is no share to give out.
    """
    if normalise not in NORMALISE or storage not in STORAGE:
        raise ValueError(f"normalise is one of {NORMALISE}, storage one of {STORAGE}")
    share = F.col("plan_qty").cast("double") * (_weight_on(F.col("date")) / F.col("_total"))
    return (
        _totalled(plan, normalise)
        .withColumn(
            "_total",
            F.when(
                _unusable(),
                F.raise_error(
                    F.concat(
                        F.lit("plan without quantity or weights: "),
                        F.concat_ws("/", "plan_month", "region", "chain_id", "product_group"),
                    )
                ).cast("double"),
            ).otherwise(F.col("_total")),
        )
        .select("*", F.explode("_days").alias("date"))
        .select(
            "date",
            "region",
            "chain_id",
            "product_group",
            share.cast(storage).alias("plan_qty"),
            *keep,
        )
    )
