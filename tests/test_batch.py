import datetime as dt

import pytest

from salesmart import schemas
from salesmart.operators import checks
from salesmart.plans.batch import run, validate
from salesmart.session import shuffle_partitions, size_shuffles
from salesmart.sinks.warehouse import Warehouse, differing_rows
from salesmart.sources import files
from tests.conftest import rows_of

BOM = "﻿"
SALES = '''doc_id,date,region,chain_id,chain_name,customer_id,sku_id,product_group,qty,revenue_byn
1,2025-01-01,Минск ,CH1,Chain,C1,SKU_OLD_001,Meat,10,100
1,2025-01-02,Минск ,CH1,Chain,C1,SKU_OLD_001,Meat,99,100
2,2025-01-02,Минск,CH1,Chain,C1, SKU_002 ,Meat,-4,-40
3,2025-01-02,Брест,CH2,"Shop ""B""",C2,SKU_002,Meat,2.5,25
4,2025-02-01,Брест,CH2,"Shop ""B""",,SKU_002,Meat,1,25
'''
PLAN = """month,region,chain_id,chain_name,product_group,plan_qty,mon_weight,tue_weight,wed_weight,thu_weight,fri_weight,sat_weight,sun_weight
2025-01,Минск,CH1,Chain,Meat,310,1,1,1,1,1,1,1
2025-02,Минск,CH1,Chain,Meat,280,1,1,1,1,1,0.55,0.25
"""
LINKS = """old_sku_id,current_sku_id,valid_from,valid_to
SKU_OLD_001,SKU_001,2025-01-01,
"""
STOCK = """date,warehouse_id,warehouse_name,sku_id,operation_type,qty,unit_cost_byn
2025-01-01,W1,Main,SKU_001,income,10,2
2025-01-02,W1,Main,SKU_001,outcome,4,2
"""
CATALOG = """sku_id,sku_name,product_group,base_price_byn
SKU_001,Sausage,Meat,12.0
"""


@pytest.fixture
def inputs(tmp_path):
    def build(**texts):
        given = {
            "sales_1c": SALES,
            "plan": PLAN,
            "sku_links": LINKS,
            "stock_movements_optional": STOCK,
            "product_catalog_optional": CATALOG,
            **texts,
        }
        folder = tmp_path / "in"
        folder.mkdir()
        for name, text in given.items():
            if text is not None:
                (folder / f"{name}.csv").write_text(BOM + text, encoding="utf-8")
        return str(folder)

    return build


def test_files_to_marts(spark, inputs, tmp_path):
    outcome = run(spark, inputs(), str(tmp_path / "out"))
    read = outcome.warehouse.read
    counts = {row.table: row.n_rows for row in outcome.counts.collect()}
    assert counts == {
        "raw_sales_1c": 5,
        "raw_plan": 2,
        "raw_sku_links": 1,
        "stg_sku_links": 1,
        "stg_sales": 4,
        "dup_docs": 1,
        "stg_plan_raw": 2,
        "stg_plan_daily": 59,
        "sales_daily": 4,
        "plan_daily_agg": 59,
        "mart_sales_plan_daily": 61,
        "mart_last_customer_operation": 3,
        "mart_rolling_7d": 4,
        "mart_rolling_7_days": 4,
        "mart_mtd": 4,
        "raw_product_catalog": 1,
        "sales_with_catalog": 4,
        "raw_stock_movements": 2,
        "stg_stock_movements": 2,
        "mart_stock_daily": 2,
        "mart_stock_end_of_day": 2,
    }
    mart = read("mart_sales_plan_daily").filter("region = 'Минск'")
    assert rows_of(mart.filter("date < '2025-01-04'"), "date", "actual_qty", "completion_pct") == [
        ("2025-01-01", 10.0, 100.0),
        ("2025-01-02", -4.0, -40.0),
        ("2025-01-03", 0.0, 0.0),
    ]
    assert rows_of(read("mart_last_customer_operation"), "customer_id", "last_doc_id") == [
        ("C1", "2"),
        ("C2", "3"),
        (None, "4"),
    ]
    assert rows_of(read("sales_with_catalog").filter("sku_name is not null"), "doc_id") == [("1",)]
    assert outcome.report.filter("NOT passed").isEmpty()
    assert rows_of(read("sales_daily").filter("region = 'Брест'"), "chain_name")[0] == ('Shop "B"',)


def test_empty_group_fails_the_key_check(spark, inputs, tmp_path):
    sales = SALES + '5,2025-02-01,Брест,CH2,Shop,,SKU_002,"",1,25\n'
    with pytest.raises(checks.ChecksFailed, match="null_mart_keys: 1"):
        run(spark, inputs(sales_1c=sales), str(tmp_path / "out"))


def test_second_run_leaves_the_same_tables(spark, inputs, tmp_path):
    folder = inputs()
    first = run(spark, folder, str(tmp_path / "a"), marts_by_month=True).warehouse
    names = list(first.tables)
    run(spark, folder, str(tmp_path / "b"), marts_by_month=True)
    second = run(spark, folder, str(tmp_path / "b"), marts_by_month=True).warehouse
    assert sorted(second.tables) == sorted(names)
    for name in names:
        assert differing_rows(first.read(name), second.read(name)).isEmpty(), name
    january = second.read("mart_mtd").filter("month = '2025-01'")
    assert "PartitionFilters: [isnotnull(month" in january._jdf.queryExecution().toString()
    assert january.count() == 3


def test_optional_inputs_may_be_missing(spark, inputs, tmp_path, caplog):
    folder = inputs(stock_movements_optional=None, product_catalog_optional=None)
    outcome = run(spark, folder, str(tmp_path / "out"))
    assert "mart_mtd" in outcome.warehouse.tables
    assert not any("stock" in name or "catalog" in name for name in outcome.warehouse.tables)
    assert caplog.text.count("not found, skipped") == 2
    assert outcome.report.filter("check = 'negative_stock'").isEmpty()


def test_required_input_must_exist(spark, inputs, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run(spark, inputs(plan=None), str(tmp_path / "out"))


def test_malformed_value_fails_or_goes_to_quarantine(spark, inputs, tmp_path):
    folder = inputs(
        sales_1c=SALES
        + "6,2025-13-45,Брест,CH2,Shop,C9,SKU_002,Meat,oops,1\n7,,Брест,CH2,Shop,C9,SKU_002,Meat,1,1\n"
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run(spark, folder, str(tmp_path / "a"))
    outcome = run(spark, folder, str(tmp_path / "b"), quarantine=True, fail_on_checks=False)
    bad = outcome.warehouse.read("bad_sales")
    assert rows_of(bad.selectExpr("doc_id", "qty", "array_join(bad_columns, ',') AS bad")) == [
        ("6", "oops", "date,qty")
    ]
    assert outcome.warehouse.read("raw_sales_1c").count() == 6


def test_options(spark, inputs, tmp_path):
    outcome = run(
        spark,
        inputs(sku_links=LINKS.replace("2025-01-01", "2025-01-02")),
        str(tmp_path / "out"),
        sku_by_date=True,
        fill_chain_name=True,
        empty_as_null=True,
        plan_storage="double",
        normalise="week",
        fail_on_checks=False,
    )
    read = outcome.warehouse.read
    assert rows_of(read("stg_sales").filter("doc_id = '1'"), "sku_id") == [("SKU_OLD_001",)]
    assert read("mart_sales_plan_daily").filter("chain_name = ''").isEmpty()
    assert dict(read("stg_plan_daily").dtypes)["plan_qty"] == "double"
    failed = {row.check for row in outcome.report.filter("NOT passed").collect()}
    assert failed == {"old_sku", "plan_sum"}


def test_tables_can_be_asked_in_sql(spark, inputs, tmp_path):
    run(spark, inputs(), str(tmp_path / "out")).warehouse.register_views()
    found = spark.sql(
        """
        WITH days AS (
          SELECT CAST(date_trunc('MONTH', date) AS DATE) AS plan_month, region, chain_id,
                 product_group, SUM(plan_qty) AS spread
          FROM stg_plan_daily GROUP BY 1, 2, 3, 4)
        SELECT * FROM stg_plan_raw JOIN days USING (plan_month, region, chain_id, product_group)
        WHERE abs(spread - plan_qty) <= 0.01
        """
    )
    assert found.count() == 2


def test_columns_are_found_by_name_and_separator_by_header(spark, tmp_path):
    path = tmp_path / "links.csv"
    path.write_text(
        BOM + "note;valid_from;current_sku_id;valid_to;old_sku_id\nx;2025-01-01;N,1;;O\n",
        encoding="utf-8",
    )
    found = files.read_csv(spark, str(path), schemas.RAW_SKU_LINKS)
    assert found.schema.simpleString() == schemas.RAW_SKU_LINKS.simpleString()
    assert found.first() == ("O", "N,1", dt.date(2025, 1, 1), None)


def test_folder_of_files_is_read_whole_and_headers_must_agree(spark, tmp_path):
    (tmp_path / "1.csv").write_text("old_sku_id,current_sku_id,valid_from,valid_to\nA,B,,\n")
    (tmp_path / "2.csv").write_text("old_sku_id,current_sku_id,valid_from,valid_to\nC,D,,\n")
    found = files.read_csv(spark, str(tmp_path), schemas.RAW_SKU_LINKS)
    assert rows_of(found, "old_sku_id") == [("A",), ("C",)]
    (tmp_path / "3.csv").write_text("current_sku_id,old_sku_id,valid_from,valid_to\nX,Y,,\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path), schemas.RAW_SKU_LINKS).collect()


def test_sorted_table_has_disjoint_files_in_order(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    df = spark.range(1000).selectExpr("id", "(id * 7919) % 1000 AS k")
    stored = store.replace("mart", "t", df, order=["k"])
    per_file = sorted(
        tuple(r)
        for r in stored.selectExpr("input_file_name() AS f", "k")
        .groupBy("f")
        .agg({"k": "min", "*": "count"})
        .select("min(k)", "count(1)")
        .collect()
    )
    start = 0
    for low, n in per_file:
        assert low == start
        start += n


def test_shuffle_partitions_grow_with_the_input(spark, tmp_path):
    assert shuffle_partitions(1000, 8) == 8
    assert shuffle_partitions(100 << 40, 200) == 819200
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    (tmp_path / "x").write_bytes(b"abc")
    size_shuffles(spark, str(tmp_path / "x"))
    assert spark.conf.get(key, None) is None


def test_rows_of_one_key_are_split_among_files(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    df = spark.range(200_000).selectExpr("if(id % 3 = 0, 'HOT', concat('k', id)) AS k", "id AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = store.replace("mart", "t", df, order=["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    of_hot = stored.filter("k = 'HOT'").selectExpr("input_file_name() AS f").distinct().count()
    assert of_hot > 1 and stored.count() == 200_000


def files_of(folder) -> dict[str, float]:
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_a_stopped_write_leaves_the_old_table(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.replace("mart", "t", spark.range(10).selectExpr("id AS a"), ["a"])
    broken = spark.range(100).selectExpr("IF(id = 77, raise_error('stopped'), id) AS a")
    with pytest.raises(Exception, match="stopped"):
        warehouse.replace("mart", "t", broken, ["a"])
    assert spark.read.parquet(str(tmp_path / "mart/t")).count() == 10
    again = Warehouse.open(spark, str(tmp_path))
    assert again.read("t").count() == 10
    assert [p.name for p in (tmp_path / "mart").iterdir()] == ["t"]  # what it left is gone


def test_a_run_stopped_between_the_renames_is_made_good(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.replace("mart", "t", spark.range(10).selectExpr("id AS a"))
    rename = Warehouse._rename

    def stop(self, source, to):
        if "_new-" in source:
            raise KeyboardInterrupt
        rename(self, source, to)

    monkeypatch.setattr(Warehouse, "_rename", stop)
    with pytest.raises(KeyboardInterrupt):
        warehouse.replace("mart", "t", spark.range(3).selectExpr("id AS a"))
    monkeypatch.undo()
    assert not (tmp_path / "mart/t").exists()
    assert Warehouse.open(spark, str(tmp_path)).read("t").count() == 10
    warehouse.replace("mart", "t", spark.range(3).selectExpr("id AS a"))
    assert Warehouse.open(spark, str(tmp_path)).read("t").count() == 3


def test_one_month_is_replaced_and_others_keep_their_files(spark, tmp_path):
    days = spark.sql("SELECT explode(sequence(DATE'2025-01-01', DATE'2025-04-30')) AS date, 1 AS n")
    warehouse = Warehouse(spark, str(tmp_path))
    warehouse.replace("mart", "t", days, ["date"], "date")
    before = files_of(tmp_path / "mart/t")
    changed = days.selectExpr("date", "2 AS n").filter("date < '2025-03-01' OR date >= '2025-04-10'")
    back = warehouse.replace_months("mart", "t", changed, ["2025-02", "2025-03"], "date", ["date"])
    after = files_of(tmp_path / "mart/t")
    other = {f for f in before if "2025-01" in f or "2025-04" in f}
    assert other and all(after[f] == before[f] for f in other)
    assert set(after) - other and not set(after) & (set(before) - other)
    counts = {(r.m, r.n): r["count"] for r in back.selectExpr("month(date) AS m", "n").groupBy("m", "n").count().collect()}
    assert counts == {(1, 1): 31, (2, 2): 28, (4, 1): 30}  # March had no rows any more
    assert sorted(p.name for p in (tmp_path / "mart").iterdir()) == ["t"]
    warehouse.replace("mart", "flat", days)
    with pytest.raises(ValueError):
        warehouse.replace_months("mart", "flat", days, ["2025-01"], "date")


def test_a_run_for_some_months_leaves_the_daily_marts_of_others(spark, inputs, tmp_path):
    folder, out = inputs(), tmp_path / "out"
    first = run(spark, folder, str(out), marts_by_month=True)
    report = rows_of(first.report)
    before = files_of(out / "mart/mart_mtd")
    again = run(spark, folder, str(out), marts_by_month=True, months=["2025-02"]).warehouse
    after = files_of(out / "mart/mart_mtd")
    assert {f: t for f, t in before.items() if "2025-01" in f} == {f: t for f, t in after.items() if "2025-01" in f}
    assert not {f for f in before if "2025-02" in f} & set(after)
    full = run(spark, folder, str(tmp_path / "full"), marts_by_month=True)
    for name in ("mart_mtd", "mart_rolling_7d", "mart_stock_daily", "mart_sales_plan_daily"):
        assert differing_rows(again.read(name), full.warehouse.read(name)).isEmpty()
    assert rows_of(full.report) == report
    with pytest.raises(ValueError):
        run(spark, folder, str(out), months=["2025-02"])


def test_counts_of_the_writes_are_the_tables_counts(spark, inputs, tmp_path):
    outcome = run(spark, inputs(), str(tmp_path / "out"))
    warehouse = outcome.warehouse
    counted = {r.table: r.n_rows for r in outcome.counts.collect()}
    assert set(warehouse.tables) - set(counted) == {"layer_counts", "check_report"}
    assert counted == {name: warehouse.read(name).count() for name in counted}
    assert counted["dup_docs"] == 1 and counted["raw_sales_1c"] == 5


def test_a_bad_row_of_every_input_goes_to_quarantine(spark, inputs, tmp_path):
    folder = inputs(
        sales_1c=SALES + "6,oops,Брест,CH2,Shop,C9,SKU_002,Meat,1,1\n",
        plan=PLAN
        + "2025-13,Минск,CH1,Chain,Fish,10,1,1,1,1,1,1,1\n2025-01,Минск,CH1,Chain,Fish,ten,1,1,1,1,1,1,1\n"
        + "2025-01,Минск,CH1,Chain,Milk,10,0,0,0,0,0,0,0\n2025-01,Минск,CH1,Chain,Eggs,10,1,,1,1,1,1,1\n",
        sku_links=LINKS + "SKU_OLD_002,SKU_002,someday,\n",
        stock_movements_optional=STOCK + "2025-01-03,W1,Main,SKU_001,income,many,2\n",
        product_catalog_optional=CATALOG + "SKU_003,Cheese,Milk,cheap\n",
    )
    read = run(spark, folder, str(tmp_path / "out"), quarantine=True).warehouse.read
    bad = {
        name: rows_of(read(name).selectExpr("array_join(bad_columns, ',') AS bad"))
        for name in ("bad_sales", "bad_plan", "bad_sku_links", "bad_stock_movements", "bad_product_catalog")
    }
    assert bad == {
        "bad_sales": [("date",)],
        "bad_plan": [("month",), ("plan_qty",)],
        "bad_sku_links": [("valid_from",)],
        "bad_stock_movements": [("qty",)],
        "bad_product_catalog": [("base_price_byn",)],
    }
    assert rows_of(read("plan_not_spread"), "product_group", "reason") == [
        ("Eggs", "a weight is missing"), ("Milk", "weights add up to 0"),
    ]
    counts = {name: read(name).count() for name in ("raw_plan", "stg_plan_raw", "raw_sku_links", "raw_stock_movements")}
    assert counts == {"raw_plan": 4, "stg_plan_raw": 2, "raw_sku_links": 1, "raw_stock_movements": 2}


def test_stored_tables_are_checked_and_asked_by_name(spark, inputs, tmp_path):
    out = str(tmp_path / "out")
    outcome = run(spark, inputs(), out, marts_by_month=True)
    assert rows_of(validate(spark, out)) == rows_of(outcome.report)
    opened = Warehouse.open(spark, out)
    assert set(opened.tables) == set(outcome.warehouse.tables)
    opened.register_tables("dwh_test")
    other = spark.newSession()
    mtd = other.sql("SELECT * FROM dwh_test.mart_mtd WHERE month = '2025-01'")
    assert mtd.count() == outcome.warehouse.read("mart_mtd").filter("month = '2025-01'").count() > 0
    assert other.table("dwh_test.stg_sales").schema == outcome.warehouse.read("stg_sales").schema
    spark.read.parquet(f"{out}/stg/stg_plan_daily").limit(0).write.mode("overwrite").parquet(f"{out}/stg/none")
    lost = spark.read.parquet(f"{out}/stg/stg_plan_daily").filter("date <> '2025-01-05'")
    opened.replace("stg", "stg_plan_daily", lost)
    with pytest.raises(checks.ChecksFailed, match="plan_days"):
        validate(spark, out)
