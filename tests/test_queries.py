"""Every registered query against its SQL, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as entry_points
from oracle.sql import ORACLES as ORACLE_SQL
from salesmart import schemas
from salesmart.operators import series
from salesmart.plans import registry
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Those of the sales part; the training-data queries have their tests in tests/llm.
QUERIES = {name: query for name, query in entry_points.queries().items() if name in registry.queries()}
ORACLES = {name: sql for name, sql in entry_points.oracle_sql().items() if name in ORACLE_SQL}


def test_the_entry_point_has_every_query():
    assert set(QUERIES) == set(registry.queries()) and set(ORACLES) == set(ORACLE_SQL)


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, tables, name):
    assert differences(QUERIES[name](spark, SF_DIR), tables, ORACLES[name]) == []


def test_entry_runs(spark):
    df = entry_points.entry(spark)
    assert df.columns[:2] == ["date", "region"]
    assert not df.isEmpty()


def plan_of(spark, name) -> str:
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_pairs_everything_or_leaves_the_jvm(spark, name):
    plan = plan_of(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas"):
        assert operator not in plan


@pytest.mark.parametrize("name", ["stg_sales", "last_customer_operation"])
def test_ranking_keeps_one_row_per_key_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan


def test_lines_are_not_shuffled_to_meet_small_tables(spark):
    # one exchange for the documents, one for the daily totals
    assert plan_of(spark, "sales_daily").count(" Exchange hashpartitioning") == 2


def test_spread_needs_no_shuffle_of_its_own(spark):
    both = [plan_of(spark, name).count(" Exchange hashpartitioning") for name in ("stg_plan", "plan_daily")]
    assert both == [1, 1]


def test_only_needed_columns_are_read(spark):
    plan = plan_of(spark, "stock_per_movement")
    assert "l_extendedprice" not in plan and "l_orderkey" not in plan
    assert "orders.parquet" not in plan_of(spark, "mart_sales_plan_daily")


@pytest.mark.parametrize("mart", [series.rolling_7_rows, series.rolling_7_days, series.month_to_date])
def test_region_filter_reaches_the_scan_of_the_daily_table(spark, make, tmp_path, mart):
    path = str(tmp_path / "sales_daily")
    make(schemas.SALES_DAILY, {"region": "R", "actual_qty": 1}).write.parquet(path)
    plan = mart(spark.read.parquet(path)).filter("region = 'R'")._jdf.queryExecution().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("EqualTo(region,R)" in line for line in scans)


def test_days_wanted_of_month_to_date_reach_the_scan(spark, make, tmp_path):
    path = str(tmp_path / "sales_daily")
    make(schemas.SALES_DAILY, {"region": "R", "actual_qty": 1}).write.parquet(path)
    mtd = series.month_to_date(spark.read.parquet(path), "2025-01-05", "2025-01-07")
    scans = [x for x in mtd._jdf.queryExecution().toString().splitlines() if "FileScan" in x]
    assert scans and all("GreaterThanOrEqual(date,2025-01-01)" in line for line in scans)


def test_top_rows_are_taken_without_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "rolling_region_top5")


@pytest.mark.parametrize(
    "name, keys",
    [
        ("stock_per_movement", ("warehouse_id", "sku_id", "date")),
        ("mtd", ("region", "chain_name", "product_group", "_month", "date")),
    ],
)
def test_long_series_are_shuffled_by_day(spark, name, keys):
    exchanges = [line for line in plan_of(spark, name).splitlines() if " Exchange hash" in line]
    partitioned_by = exchanges[0].split("hashpartitioning(")[1]
    found = [part.split("#")[0].strip() for part in partitioned_by.split(",")][: len(keys)]
    assert tuple(found) == keys


@pytest.mark.parametrize("name", ["check_report", "layer_counts"])
def test_reports_read_the_line_items_once(spark, monkeypatch, name):
    from salesmart.sources import starschema

    read, table = [], starschema.table
    monkeypatch.setattr(starschema, "table", lambda s, d, n: read.append(n) or table(s, d, n))
    report = QUERIES[name](spark, SF_DIR)
    assert read.count("lineitem") == 1
    assert not [f for f in report.inputFiles() if f.endswith("lineitem.parquet")]
