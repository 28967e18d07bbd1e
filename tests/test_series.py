import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from salesmart import schemas
from salesmart.functions.ordering import ascending
from salesmart.operators import facts, ranges, series, stock
from salesmart.sinks.warehouse import differing_rows
from tests.conftest import rows_of

DAY = {"region": "R", "chain_id": "C1", "chain_name": "N", "product_group": "G"}


@pytest.fixture
def daily(make):
    return lambda *rows: make(schemas.SALES_DAILY, *[{**DAY, **row} for row in rows])


@pytest.fixture
def many(daily):
    """Several series, one much longer, some NULL keys, dates and quantities."""
    pick = random.Random(7)
    rows = []
    for n in range(900):
        hot = n % 3 != 0
        rows.append(
            {
                "region": "HOT" if hot else pick.choice(["A", "B", None]),
                "chain_name": "N" if hot else pick.choice(["N", "", None]),
                "chain_id": f"C{n}",
                "date": pick.choice([None, *[f"2025-{m:02}-{d:02}" for m in (1, 2) for d in range(1, 9)]]),
                "actual_qty": pick.choice([None, pick.randint(-50, 50)]),
            }
        )
    return daily(*rows).repartition(3)


def plain(df, keys, frame_start, upto=0):
    order = ascending(["date", "chain_id"])
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(frame_start, upto)
    return df.withColumn("out", F.sum("actual_qty").over(window))


@pytest.mark.parametrize("parts", [(), (["date"],), (["region2"], ["region2", "date"])])
@pytest.mark.parametrize("upto", [0, -1])
def test_running_sum_equals_the_plain_window(many, parts, upto):
    df = many.withColumn("region2", F.trunc("date", "month"))
    order = ["chain_id"] if parts else ["date", "chain_id"]
    found = series.running_sum(df, series.SERIES, order, "actual_qty", "out", parts, upto)
    expected = plain(df, series.SERIES, Window.unboundedPreceding, upto)
    assert found.columns == expected.columns
    assert rows_of(found) == rows_of(expected)


@pytest.mark.parametrize("block_rows", [7, 10, 64, 8192])
def test_rolling_sum_equals_the_plain_window(many, block_rows):
    found = series.rolling_sum(
        many, series.SERIES, ["chain_id"], "actual_qty", "out", 7, [["date"]], block_rows
    )
    assert rows_of(found) == rows_of(plain(many, series.SERIES, -6))


def test_rolling_block_must_hold_the_frame(many):
    with pytest.raises(ValueError):
        series.rolling_sum(many, series.SERIES, ["chain_id"], "actual_qty", "out", 7, (), 6)


def test_month_to_date_equals_the_plain_window(many):
    month = F.trunc("date", "month")
    df = many.withColumn("m", month)
    expected = plain(df, [*series.SERIES, "m"], Window.unboundedPreceding)
    columns = ["date", *series.SERIES, "actual_qty"]
    assert rows_of(series.month_to_date(many)) == rows_of(expected, *columns, "out")


def test_month_to_date_between_days_equals_the_filtered_mart(many):
    whole = series.month_to_date(many).filter("date between '2025-01-05' and '2025-02-03'")
    cut = series.month_to_date(many, "2025-01-05", "2025-02-03")
    assert rows_of(cut) == rows_of(whole)


def test_gap_is_spanned_by_rows_but_not_by_days(daily):
    df = daily({"date": "2025-01-01", "actual_qty": 5}, {"date": "2025-01-12", "actual_qty": 1})
    measure = ("date", "rolling_7d_actual_qty")
    assert rows_of(series.rolling_7_rows(df), *measure) == [("2025-01-01", 5.0), ("2025-01-12", 6.0)]
    assert rows_of(series.rolling_7_days(df), *measure) == [("2025-01-01", 5.0), ("2025-01-12", 1.0)]


def test_rolling_days_sums_all_chains_of_a_name(daily):
    df = daily(
        {"date": "2025-01-01", "actual_qty": 1},
        {"date": "2025-01-01", "actual_qty": 2, "chain_id": "C2"},
        {"date": "2025-01-07", "actual_qty": 4},
        {"date": "2025-01-08", "actual_qty": 8, "region": None},
        {"date": "2025-01-08", "actual_qty": 16, "region": None, "chain_id": "C2"},
    )
    found = rows_of(series.rolling_7_days(df), "date", "actual_qty", "rolling_7d_actual_qty")
    assert found == [
        ("2025-01-01", 1.0, 3.0),
        ("2025-01-01", 2.0, 3.0),
        ("2025-01-07", 4.0, 7.0),
        ("2025-01-08", 8.0, 24.0),
        ("2025-01-08", 16.0, 24.0),
    ]


def test_eighth_row_leaves_the_first_out(daily):
    df = daily(*[{"date": f"2025-01-0{d}", "actual_qty": d} for d in range(1, 9)])
    sums = [s for _, s in rows_of(series.rolling_7_rows(df), "date", "rolling_7d_actual_qty")]
    assert sums == [1, 3, 6, 10, 15, 21, 28, 35]


def test_month_change_starts_over(daily):
    df = daily(
        {"date": "2025-01-31", "actual_qty": 3},
        {"date": "2025-02-01", "actual_qty": -2},
        {"date": "2025-02-02", "actual_qty": 5},
    )
    sums = [s for _, s in rows_of(series.month_to_date(df), "date", "mtd_actual_qty")]
    assert sums == [3, -2, 3]


def test_a_hot_day_is_split_and_sums_stay(spark):
    hot = spark.range(20_000).selectExpr(
        "DATE'2025-03-05' AS date", "'W1' AS warehouse_id", "'Main' AS warehouse_name", "'S1' AS sku_id",
        "IF(id % 3 = 0, 'outcome', 'income') AS operation_type",
        "CAST(IF(id % 2 = 0, 1, id % 7) AS DECIMAL(12,2)) AS qty", "CAST(id % 2 AS DECIMAL(12,2)) AS unit_cost_byn",
    )
    others = spark.range(900).selectExpr(
        "date_add(DATE'2025-03-01', CAST(id % 9 AS INT)) AS date", "concat('W', id % 4) AS warehouse_id", "'Main' AS warehouse_name",
        "IF(id % 5 = 0, NULL, 'S1') AS sku_id", "'income' AS operation_type", "CAST(2 AS DECIMAL(12,2)) AS qty",
        "CAST(1 AS DECIMAL(12,2)) AS unit_cost_byn",
    )
    moves = hot.unionByName(others)
    cut = ranges.ranged(moves, [*stock.STOCK_KEYS, "date", *stock.WITHIN_DAY], 6)
    of_day = cut.filter("warehouse_id = 'W1' AND date = '2025-03-05'").groupBy("_range").count().collect()
    tasks = cut.select("_range").distinct().count()
    assert tasks == 6 and len(of_day) >= 5 and max(r["count"] for r in of_day) < 1.5 * 20_900 / tasks
    plain = stock.stock_per_movement(moves, ["date", *stock.WITHIN_DAY], parts=())
    assert differing_rows(stock.stock_per_movement(moves, by_ranges=True), plain).isEmpty()
    summed = series.running_sum(
        cut.withColumn("_change", stock.stock_change()), stock.STOCK_KEYS, ["date", *stock.WITHIN_DAY, "_tie"],
        "_change", "stock_qty", [["_range"]],
    )
    assert differing_rows(stock._valued(summed), plain).isEmpty()


def test_sums_by_ranges_equal_the_plain_windows(spark, make):
    daily = spark.range(3000).selectExpr(
        "date_add(DATE'2025-01-28', CAST(id % 11 AS INT)) AS date", "IF(id % 13 = 0, NULL, 'North') AS region",
        "concat('CH', id % 300) AS chain_id", "'Name' AS chain_name", "concat('G', id % 2) AS product_group",
        "CAST(id % 17 - 3 AS DECIMAL(38,2)) AS actual_qty",
    ).dropDuplicates(["date", "region", "chain_id", "product_group"])
    daily = spark.createDataFrame(daily.collect(), daily.schema)
    for by_days, by_ranges in (
        (series.month_to_date(daily), series.month_to_date(daily, by_ranges=True)),
        (series.rolling_7_rows(daily), series.rolling_7_rows(daily, by_ranges=True)),
    ):
        assert differing_rows(by_days, by_ranges).isEmpty()
    assert series.month_to_date(daily.limit(0), by_ranges=True).collect() == []


def test_sums_of_doubles_do_not_depend_on_the_partitions(spark):
    rows = spark.range(40_000).selectExpr(
        "DATE'2025-01-01' AS date", "'r' AS region", "concat('c', id % 3) AS chain_id", "'g' AS product_group",
        "IF(id % 2 = 0, 1e9, 1) * sin(id) AS plan_qty",
    )
    found = set()
    for n in (1, 3, 7):
        dealt = rows.repartition(n, "plan_qty")
        found.add(tuple(sorted((r.chain_id, r.plan_qty.hex()) for r in facts.plan_daily_agg(dealt).collect())))
    assert len(found) == 1
    exact = dict(next(iter(found)))
    values = [(r.chain_id, r.plan_qty) for r in rows.collect()]
    for chain in exact:
        assert abs(float.fromhex(exact[chain]) - math.fsum(v for c, v in values if c == chain)) < 1e-3
