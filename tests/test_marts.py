import random

import pytest

from salesmart import schemas
from salesmart.operators import checks, facts, marts, samples
from tests.conftest import rows_of

KEY = {"date": "2025-01-10", "region": "R", "chain_id": "C", "product_group": "G"}


@pytest.fixture
def mart(make):
    def build(sales, plan, **options):
        s = make(schemas.SALES_DAILY, *[{**KEY, "chain_name": "N", **row} for row in sales])
        p = make(schemas.PLAN_DAILY_AGG, *[{**KEY, **row} for row in plan])
        return marts.sales_plan_daily(s, p, **options)

    return build


MEASURES = ("chain_name", "actual_qty", "plan_qty", "delta", "completion_pct")


def test_matched_row(mart):
    df = mart([{"actual_qty": 5}], [{"plan_qty": 4}])
    assert df.schema.simpleString() == schemas.MART_SALES_PLAN.simpleString()
    assert rows_of(df, *MEASURES) == [("N", 5.0, 4.0, 1.0, 125.0)]


def test_fact_without_plan_and_plan_without_fact(mart):
    df = mart([{"actual_qty": 5}], [{"plan_qty": 4, "date": "2025-01-11"}])
    assert rows_of(df, "date", *MEASURES) == [
        ("2025-01-10", "N", 5.0, 0.0, 5.0, None),
        ("2025-01-11", "", 0.0, 4.0, -4.0, 0.0),
    ]


def test_plan_of_zero_has_no_percentage(mart):
    df = mart([{"actual_qty": 5}], [{"plan_qty": 0}])
    assert rows_of(df, *MEASURES) == [("N", 5.0, 0.0, 5.0, None)]


def test_null_keys_never_match(mart):
    df = mart([{"region": None, "actual_qty": 1}], [{"region": None, "plan_qty": 2}])
    assert df.count() == 2
    assert checks.null_profile(df).first().asDict() == {
        "total": 2,
        "null_date": 0,
        "null_region": 2,
        "null_chain_id": 0,
        "null_product_group": 0,
        "null_keys": 2,
    }


def test_chain_with_two_names_repeats_its_plan_and_is_reported(mart):
    df = mart([{"actual_qty": 1}, {"chain_name": "M", "actual_qty": 2}], [{"plan_qty": 4}])
    assert rows_of(df, "chain_name", "plan_qty") == [("M", 4.0), ("N", 4.0)]
    assert rows_of(checks.duplicate_mart_keys(df), "chain_id", "dup_count") == [("C", 2)]


def test_returns_only_day(make):
    sales = make(
        schemas.STG_SALES, {**KEY, "doc_id": "1", "qty": -5}, {**KEY, "doc_id": "2", "qty": 2}
    )
    daily = facts.sales_daily(sales)
    assert daily.schema.simpleString() == schemas.SALES_DAILY.simpleString()
    assert rows_of(daily, "actual_qty") == [(-3.0,)]
    assert rows_of(checks.returns_profile(sales)) == [(1, -5.0)]


def test_chain_name_from_the_plan(make):
    sales = make(schemas.SALES_DAILY, {**KEY, "chain_name": "N", "actual_qty": 1})
    plan = make(
        schemas.PLAN_DAILY_AGG, {**KEY, "plan_qty": 1}, {**KEY, "region": "Q", "plan_qty": 1}
    ).selectExpr("*", "'P' AS chain_name")
    found = marts.sales_plan_daily(sales, plan, fill_chain_name=True)
    assert rows_of(found, "region", "chain_name") == [("Q", "P"), ("R", "N")]


def test_last_operation_by_date_then_document(make):
    rows = [
        ("C1", "A", "2025-01-01"),
        ("C1", "B", "2025-01-02"),
        ("C1", "C", "2025-01-02"),
        ("C1", "D", None),
        ("C2", "E", None),
        (None, "F", "2025-01-01"),
    ]
    df = make(
        schemas.STG_SALES,
        *[{"customer_id": c, "doc_id": d, "date": on, "qty": -1} for c, d, on in rows],
    )
    found = marts.last_customer_operation(df)
    assert found.columns == [
        "customer_id",
        "last_doc_id",
        "last_date",
        "last_sku_id",
        "last_qty",
        "last_revenue_byn",
    ]
    assert rows_of(found, "customer_id", "last_doc_id") == [("C1", "C"), ("C2", "E"), (None, "F")]
    assert samples.last_operation_sample(found, 1).first().customer_id == "C1"


def test_catalog_names_known_products_only(make):
    sales = make(
        schemas.STG_SALES, {"doc_id": "1", "sku_id": "SKU_001"}, {"doc_id": "2", "sku_id": "X"}
    )
    catalog = make(
        schemas.RAW_CATALOG, {"sku_id": "SKU_001", "sku_name": "Tea", "base_price_byn": 12}
    )
    found = marts.with_catalog(sales, catalog)
    assert rows_of(found, "doc_id", "sku_name", "base_price_byn") == [
        ("1", "Tea", 12.0),
        ("2", None, None),
    ]


def test_summary_and_sample(mart):
    df = mart(
        [{"actual_qty": 5}, {"date": "2025-01-12", "actual_qty": -1}],
        [{"plan_qty": 4, "date": "2025-01-11"}],
    )
    assert rows_of(marts.mart_summary(df)) == [("2025-01-10", "2025-01-12", 4.0, 4.0, 3)]
    assert rows_of(samples.mart_sample(df), "date") == [("2025-01-10",), ("2025-01-11",)]


def test_mart_loses_and_invents_nothing(make):
    pick = random.Random(5)
    sales, plan = [], []
    for region in ("A", "B", None):
        for day in range(1, 29):
            for group in "GH":
                row = {**KEY, "region": region, "date": f"2025-01-{day:02}", "product_group": group}
                if pick.random() < 0.6:
                    sales.append({**row, "chain_name": "N", "actual_qty": pick.randint(-9, 9)})
                if pick.random() < 0.6:
                    plan.append({**row, "plan_qty": pick.choice([0, 2, 5])})
    df = marts.sales_plan_daily(
        make(schemas.SALES_DAILY, *sales), make(schemas.PLAN_DAILY_AGG, *plan)
    )
    total = marts.mart_summary(df).first()
    assert float(total.total_actual) == sum(r["actual_qty"] for r in sales)
    assert total.total_plan == sum(r["plan_qty"] for r in plan)

    def keys(rows):
        return {(r["date"], r["region"], r["product_group"]) for r in rows if r["region"]}

    nulls = sum(r["region"] is None for r in [*sales, *plan])
    assert total.n_rows == len(keys(sales) | keys(plan)) + nulls
    assert df.filter("delta != cast(actual_qty as double) - plan_qty").isEmpty()
    assert df.filter("(completion_pct is null) != (plan_qty = 0)").isEmpty()
