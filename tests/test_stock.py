import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from salesmart import schemas
from salesmart.functions.ordering import ascending
from salesmart.operators import checks, samples, staging, stock
from tests.conftest import rows_of

MOVE = {
    "date": "2025-01-01",
    "warehouse_id": "W",
    "warehouse_name": "Main",
    "sku_id": "S",
    "operation_type": "income",
    "qty": 10,
    "unit_cost_byn": 2,
}
OUT = ("date", "stock_qty", "stock_value_byn")


@pytest.fixture
def moves(make):
    return lambda *rows: make(schemas.RAW_STOCK_MOVEMENTS, *[{**MOVE, **row} for row in rows])


def test_balance_after_each_movement(moves):
    df = moves(
        {},
        {"date": "2025-01-02", "operation_type": "outcome", "qty": 4, "unit_cost_byn": 2.5},
        {"date": "2025-01-03", "operation_type": "outcome", "qty": 6},
        {"date": "2025-01-04", "operation_type": "outcome", "qty": 1},
    )
    found = stock.stock_per_movement(df)
    assert found.schema.simpleString() == schemas.MART_STOCK.simpleString()
    assert rows_of(found, *OUT) == [
        ("2025-01-01", 10.0, 20.0),
        ("2025-01-02", 6.0, 15.0),
        ("2025-01-04", -1.0, -2.0),
    ]
    assert rows_of(checks.negative_stock(found), "date") == [("2025-01-04",)]
    assert rows_of(samples.stock_sample(found, 1), "date") == [("2025-01-01",)]


def test_movements_that_cancel_out_on_a_day(moves):
    df = moves({}, {"operation_type": "outcome"})
    assert rows_of(stock.stock_per_movement(df), *OUT) == [("2025-01-01", 10.0, 20.0)]
    assert stock.stock_end_of_day(df).isEmpty()


def test_other_operations_carry_the_balance(moves):
    df = staging.stg_stock_movements(
        moves(
            {"operation_type": " income "},
            {"date": "2025-01-02", "operation_type": "adjust", "qty": 3},
            {"date": "2025-01-03", "operation_type": "Income", "qty": 3},
            {"sku_id": "T", "operation_type": "adjust"},
        )
    )
    assert [r[1] for r in rows_of(stock.stock_per_movement(df), *OUT)] == [10.0, 10.0, 10.0]


def test_end_of_day_takes_the_last_cost(moves):
    df = moves(
        {"unit_cost_byn": 9},
        {"operation_type": "outcome", "qty": 4, "unit_cost_byn": 1.25},
        {"date": "2025-01-05", "qty": 1, "unit_cost_byn": 3},
    )
    assert rows_of(stock.stock_end_of_day(df), *OUT) == [
        ("2025-01-01", 6.0, 7.5),
        ("2025-01-05", 7.0, 21.0),
    ]


@pytest.mark.parametrize("parts", [(), (["date"],), (["date"], ["date", "operation_type"])])
def test_long_series_in_parts_equals_the_plain_window(moves, parts):
    pick = random.Random(3)
    df = moves(
        *[
            {
                "date": f"2025-01-{pick.randint(1, 9):02}",
                "sku_id": "HOT" if n % 3 else pick.choice("AB"),
                "operation_type": pick.choice(["income", "outcome", "adjust"]),
                "qty": pick.choice([None, pick.randint(1, 20)]),
                "unit_cost_byn": pick.randint(1, 5),
            }
            for n in range(400)
        ]
    ).repartition(3)
    order = stock.WITHIN_DAY if parts else ["date", *stock.WITHIN_DAY]
    if len(parts) == 2:
        order = order[1:]
    window = (
        Window.partitionBy(*stock.STOCK_KEYS)
        .orderBy(*ascending(["date", *stock.WITHIN_DAY]))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    expected = (
        df.withColumn("change", stock.stock_change())
        .withColumn("stock_qty", F.sum("change").over(window))
        .filter("stock_qty != 0")
        .withColumn("stock_value_byn", F.round(F.col("stock_qty") * F.col("unit_cost_byn"), 2))
    )
    found = stock.stock_per_movement(df, order, parts)
    assert rows_of(found) == rows_of(expected, *found.columns)


def test_parts_go_by_the_most_frequent_product(make):
    rows = [
        {"date": f"2025-01-0{day}" if day else None, "warehouse_id": w, "warehouse_name": n, "sku_id": "S",
         "operation_type": op, "qty": qty, "unit_cost_byn": 2}
        for w in ("A", None)
        for day, n, op, qty in ((1, "x", "income", 5), (1, "y", "outcome", 5), (2, "x", "adjust", 1),
                                (2, None, "income", 3), (0, "x", "outcome", 1), (0, "x", "income", None))
    ]
    moves = make(schemas.RAW_STOCK_MOVEMENTS, *rows)
    assert stock.parts_needed(moves, most=5) == (("date",),) and stock.parts_needed(moves, most=6) == ()
    assert stock.parts_needed(moves.limit(0)) == ()
    whole, by_day = (stock.stock_per_movement(moves, parts=p) for p in ((), (("date",),)))
    assert whole.schema == by_day.schema
    assert rows_of(whole) == rows_of(by_day) and len(rows_of(whole)) > 2
