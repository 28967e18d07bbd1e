import calendar

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart import schemas
from salesmart.operators import checks, facts
from salesmart.operators.plan import allocate_monthly
from tests.conftest import rows_of

# The usual weights of a week.
WEEK = dict(zip(schemas.WEIGHTS, (1, 1, 1, 1, 1, 0.55, 0.25), strict=True))
KEYS = {"region": "R", "chain_id": "C", "product_group": "G"}


@pytest.fixture
def plan(make):
    def build(*rows):
        return make(schemas.STG_PLAN, *[{**KEYS, "plan_qty": 100, **WEEK, **row} for row in rows])

    return build


@pytest.mark.parametrize(
    "month, days", [("2024-02-01", 29), ("2025-02-01", 28), ("2024-12-01", 31), ("2025-04-01", 30)]
)
def test_days_of_the_month_add_up_to_it(plan, month, days):
    daily = allocate_monthly(plan({"plan_month": month}))
    row = daily.agg(F.count("*"), F.sum("plan_qty"), F.min("date"), F.max("date")).first()
    assert row[0] == days
    assert row[1] == pytest.approx(100, abs=1e-9)
    assert str(row[2]) == month and row[3].day == days


def test_shares_go_by_weekday(plan):
    daily = allocate_monthly(plan({"plan_month": "2025-01-01"}))
    found = dict(rows_of(daily, "date", "plan_qty"))
    monday, saturday, sunday = (found[f"2025-01-{d}"] for d in ("06", "11", "12"))
    assert saturday / monday == pytest.approx(0.55, rel=1e-6)
    assert sunday / monday == pytest.approx(0.25)


def test_weekly_normalisation_overstates_the_month(plan):
    daily = allocate_monthly(plan({"plan_month": "2025-02-01"}), normalise="week")
    assert daily.agg(F.sum("plan_qty")).first()[0] == pytest.approx(400)


def test_float_storage_has_the_declared_schema(plan):
    daily = allocate_monthly(plan({"plan_month": "2025-01-01"}), storage="float")
    assert daily.schema.simpleString() == schemas.STG_PLAN_DAILY.simpleString()
    assert daily.agg(F.sum("plan_qty")).first()[0] == pytest.approx(100, abs=0.01)


@pytest.mark.parametrize(
    "row",
    [
        {**dict.fromkeys(schemas.WEIGHTS, 0)},
        {"sun_weight": None},
        {"plan_qty": None},
    ],
)
def test_plan_that_cannot_be_spread_fails(plan, row):
    daily = allocate_monthly(plan({"plan_month": "2025-01-01", **row}))
    with pytest.raises(Exception, match="plan without quantity or weights"):
        daily.collect()


def test_unknown_options_are_refused(plan):
    with pytest.raises(ValueError):
        allocate_monthly(plan({"plan_month": "2025-01-01"}), normalise="year")


def test_repeated_plan_rows_add_up(plan):
    twice = plan({"plan_month": "2025-01-01"}, {"plan_month": "2025-01-01", "plan_qty": 50})
    daily = facts.plan_daily_agg(allocate_monthly(twice))
    assert daily.count() == 31
    assert daily.agg(F.sum("plan_qty")).first()[0] == pytest.approx(150)
    # each row is compared with both rows' days, so both are reported
    assert checks.plan_sum_mismatches(twice, allocate_monthly(twice)).count() == 2


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    months=st.lists(
        st.tuples(
            st.integers(1990, 2040),
            st.integers(1, 12),
            st.integers(0, 10**6),
            st.lists(st.integers(1, 100), min_size=7, max_size=7),
        ),
        min_size=1,
        max_size=12,
        unique_by=lambda m: m[:2],
    )
)
def test_every_month_adds_up(plan, months):
    rows = [
        {
            "plan_month": f"{y}-{m:02}-01",
            "plan_qty": qty,
            **{w: v / 100 for w, v in zip(schemas.WEIGHTS, weights, strict=True)},
        }
        for y, m, qty, weights in months
    ]
    df = plan(*rows)
    daily = allocate_monthly(df)
    for row in checks.plan_days_in_range(df, daily).collect():
        expected = calendar.monthrange(row.plan_month.year, row.plan_month.month)[1]
        assert row.days_in_plan == row.days_in_month == expected
        assert row.sum_daily == pytest.approx(row.monthly_plan, abs=0.011)
    assert checks.plan_sum_mismatches(df, daily, 1e-5).isEmpty()
