import pytest

from salesmart import schemas
from salesmart.operators import checks, facts, marts, plan, series, staging
from salesmart.operators.plan import allocate_monthly
from tests.conftest import rows_of

KEY = {"region": "R", "chain_id": "C", "product_group": "G"}


def test_repeated_documents_are_counted(make):
    df = make(schemas.RAW_SALES, *[{"doc_id": d} for d in "AABCCC"])
    assert rows_of(checks.duplicate_doc_ids(df)) == [("A", 2), ("C", 3)]


def test_old_codes(make):
    sales = make(schemas.STG_SALES, *[{"sku_id": s} for s in ("O1", "O1", "O2", "N", None)])
    links = make(schemas.RAW_SKU_LINKS, *[{"old_sku_id": s} for s in ("O1", "O2", "O2", "O3", None)])
    assert rows_of(checks.old_skus(sales, links)) == [("O1",), ("O2",)]
    assert rows_of(checks.old_sku_count(sales, links)) == [(2,)]


def test_plan_that_misses_its_month_is_reported(make):
    weights = dict.fromkeys(schemas.WEIGHTS, 1)
    plan = make(schemas.STG_PLAN, {**KEY, "plan_month": "2025-02-01", "plan_qty": 28, **weights})
    daily = allocate_monthly(plan)
    assert checks.plan_sum_mismatches(plan, daily).isEmpty()
    short = daily.filter("date != '2025-02-28'")
    assert rows_of(checks.plan_sum_mismatches(plan, short), "sum_daily_plan") == [(27.0,)]
    assert rows_of(
        checks.plan_days_in_range(plan, short), "sum_daily", "days_in_plan", "days_in_month"
    ) == [(27.0, 27, 28)]


def test_mtd_must_start_at_the_first_day(make, spark):
    sales = make(
        schemas.SALES_DAILY,
        {**KEY, "date": "2025-01-03", "chain_name": "N", "actual_qty": 2},
        {**KEY, "date": "2025-01-03", "chain_name": "N", "chain_id": "D", "actual_qty": 5},
        {**KEY, "date": "2025-01-04", "chain_name": "N", "actual_qty": 1},
    )
    mtd = series.month_to_date(sales)
    assert checks.mtd_first_day_breaks(mtd).isEmpty()
    broken = mtd.selectExpr(
        "date", "region", "chain_name", "product_group", "actual_qty", "mtd_actual_qty + 1 AS mtd_actual_qty"
    )
    assert rows_of(checks.mtd_first_day_breaks(broken), "date", "gap") == [("2025-01-03", 1.0)]


def test_report_and_failure(make):
    raw = make(
        schemas.RAW_SALES,
        *[{**KEY, "doc_id": d, "date": "2025-01-03", "qty": -1, "sku_id": "O"} for d in "AAB"],
    )
    links = make(schemas.RAW_SKU_LINKS, {"old_sku_id": "O", "current_sku_id": "N"})
    plan = make(
        schemas.STG_PLAN,
        {**KEY, "plan_month": "2025-01-01", "plan_qty": 31, **dict.fromkeys(schemas.WEIGHTS, 1)},
    )

    def report(sales):
        daily_plan, daily = allocate_monthly(plan), facts.sales_daily(sales)
        mart = marts.sales_plan_daily(daily, facts.plan_daily_agg(daily_plan))
        return checks.check_report(
            raw, sales, links, plan, daily_plan, mart, series.month_to_date(daily)
        )

    good = report(staging.stg_sales(raw, links))
    assert good.schema.simpleString() == schemas.CHECK_REPORT.simpleString()
    assert rows_of(good) == [
        ("duplicate_documents", 1, True),
        ("duplicate_mart_keys", 0, True),
        ("mtd_first_day", 0, True),
        ("null_mart_keys", 0, True),
        ("old_sku", 0, True),
        ("plan_sum", 0, True),
        ("returns", 2, True),
    ]
    checks.require_passed(good)
    bad = report(staging.clean_sales(staging.first_documents(raw)))
    with pytest.raises(checks.ChecksFailed, match="old_sku: 1"):
        checks.require_passed(bad)
    checks.require_passed(bad, tolerated=["old_sku"])


def test_plan_days_are_checked_from_both_sides(spark, make):
    weights = {w: 1 for w in schemas.WEIGHTS}
    rows = [
        {"chain_id": c, "region": r, "product_group": "g", "plan_month": "2025-02-01", "plan_qty": 28, **weights}
        for c, r in (("kept", "r"), ("lost", "r"), ("short", None), ("twice", "r"), ("twice", "r"))
    ]
    monthly = make(schemas.STG_PLAN, *rows)
    daily = plan.allocate_monthly(monthly)
    assert checks.plan_coverage(monthly, daily).collect() == []
    broken = daily.filter("chain_id <> 'lost' AND NOT (chain_id = 'short' AND date = '2025-02-03')")
    unplanned = daily.filter("chain_id = 'kept' AND date < '2025-02-03'").selectExpr(
        "add_months(date, 1) AS date", "region", "chain_id", "product_group", "plan_qty"
    )
    found = checks.plan_coverage(monthly, broken.unionByName(unplanned))
    assert rows_of(found, "chain_id", "plan_month", "n_plan_rows", "n_day_rows", "n_expected") == [
        ("kept", "2025-03-01", 0, 2, 0),
        ("lost", "2025-02-01", 1, 0, 28),
        ("short", "2025-02-01", 1, 27, 28),
    ]
