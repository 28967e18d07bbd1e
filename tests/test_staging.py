import random

import pytest

from salesmart import schemas
from salesmart.operators import staging
from tests.conftest import rows_of

SALE = {
    "doc_id": "D1",
    "date": "2025-01-10",
    "region": "Минск",
    "chain_id": "CH001",
    "chain_name": "Chain",
    "customer_id": "C1",
    "sku_id": "SKU_001",
    "product_group": "G",
    "qty": 1,
    "revenue_byn": 10,
}
LINKS = [
    {"old_sku_id": "SKU_OLD_001", "current_sku_id": "SKU_001", "valid_from": "2025-01-01"},
    {"old_sku_id": "SKU_OLD_012", "current_sku_id": "SKU_012", "valid_from": "2026-02-01"},
]


@pytest.fixture
def sales(make):
    return lambda *rows: make(schemas.RAW_SALES, *[{**SALE, **row} for row in rows])


@pytest.fixture
def links(make):
    return lambda *rows: make(schemas.RAW_SKU_LINKS, *(rows or LINKS))


def test_earliest_row_of_a_document_is_kept(sales):
    df = sales({"qty": 1}, {"qty": 2, "date": "2025-01-09"}, {"qty": 3, "date": None})
    assert rows_of(staging.first_documents(df), "date", "qty") == [("2025-01-09", 2.0)]


def test_dated_row_wins_over_undated(sales):
    df = sales({"date": None, "qty": 1}, {"qty": 2})
    assert rows_of(staging.first_documents(df), "qty") == [(2.0,)]


def test_ties_go_by_the_remaining_columns(sales):
    df = sales({"qty": 5}, {"qty": 2}, {"qty": 7})
    assert rows_of(staging.first_documents(df), "qty") == [(2.0,)]


def test_order_without_its_last_columns_keeps_the_same_rows(sales):
    df = sales(
        {"qty": 5, "sku_id": "b"},
        {"qty": 2, "sku_id": "z", "revenue_byn": 3},
        {"qty": 2, "sku_id": "z", "revenue_byn": 1},
        {"qty": 2, "sku_id": "z", "revenue_byn": 1, "customer_id": "C0"},
    )
    full = staging.first_documents(df)
    for dropped in (["customer_id"], ["customer_id", "revenue_byn"]):
        pruned = staging.first_documents(df.drop(*dropped))
        assert rows_of(pruned) == rows_of(full.drop(*dropped))


def test_quarantine_and_kept_rows_make_up_the_input(spark, sales):
    rows = [{"doc_id": f"D{i % 7}", "qty": i % 3} for i in range(60)]
    rows += [{"doc_id": "HOT", "qty": 4}] * 40 + [{"doc_id": None, "qty": 1}] * 3
    df = sales(*rows).repartition(5)
    kept, left_out = staging.first_documents(df), staging.duplicate_documents(df)
    assert left_out.columns == df.columns
    assert rows_of(kept.unionByName(left_out)) == rows_of(df)
    assert kept.count() == kept.select("doc_id").distinct().count() == 9
    assert left_out.filter("doc_id = 'HOT'").count() == 39


def test_documents_that_occur_once_are_not_quarantined(sales):
    assert staging.duplicate_documents(sales({"doc_id": "A"}, {"doc_id": "B"})).isEmpty()


def test_returns_stay_and_codes_are_not_stripped(sales, links):
    df = staging.stg_sales(
        sales({"qty": -5, "region": " Минск ", "chain_id": " CH001", "doc_id": " D1"}), links()
    )
    assert rows_of(df, "doc_id", "qty", "region", "chain_id") == [(" D1", -5.0, "Минск", " CH001")]
    assert df.schema.simpleString() == schemas.STG_SALES.simpleString()


def test_old_code_with_spaces_is_replaced(sales, links):
    df = staging.stg_sales(sales({"sku_id": " SKU_OLD_001 "}), links())
    assert rows_of(df, "sku_id") == [("SKU_001",)]


def test_unknown_and_missing_codes_stay(sales, links):
    df = staging.stg_sales(
        sales({"doc_id": "A", "sku_id": " X "}, {"doc_id": "B", "sku_id": None}), links()
    )
    assert rows_of(df, "doc_id", "sku_id") == [("A", "X"), ("B", None)]


def test_validity_dates_count_only_in_the_dated_variant(sales, links):
    early = sales({"sku_id": "SKU_OLD_012", "date": "2026-01-15"})
    assert rows_of(staging.replace_sku(early, links()), "sku_id") == [("SKU_012",)]
    assert rows_of(staging.replace_sku_asof(early, links()), "sku_id") == [("SKU_OLD_012",)]
    later = sales({"sku_id": "SKU_OLD_012", "date": "2026-02-01"})
    assert rows_of(staging.replace_sku_asof(later, links()), "sku_id") == [("SKU_012",)]


def test_link_listed_twice(sales, links):
    twice = links(
        {**LINKS[0]}, {**LINKS[0], "current_sku_id": "SKU_777", "valid_from": "2025-01-05"}
    )
    df = sales({"sku_id": "SKU_OLD_001"})
    assert rows_of(staging.replace_sku(df, twice), "sku_id") == [("SKU_001",), ("SKU_777",)]
    assert rows_of(staging.replace_sku_asof(df, twice), "sku_id") == [("SKU_777",)]


def test_nested_link_gives_way_again_after_its_end(sales, links):
    nested = links(
        {**LINKS[0]},
        {
            "old_sku_id": "SKU_OLD_001",
            "current_sku_id": "T",
            "valid_from": "2025-01-05",
            "valid_to": "2025-01-08",
        },
        {"old_sku_id": "SKU_OLD_001", "current_sku_id": "NEVER", "valid_from": None},
    )
    dates = ["2024-12-31", "2025-01-04", "2025-01-05", "2025-01-08", "2025-01-09", None]
    df = sales(*[{"doc_id": str(i), "date": d, "sku_id": "SKU_OLD_001"} for i, d in enumerate(dates)])
    found = rows_of(staging.replace_sku_asof(df, nested), "doc_id", "sku_id")
    assert [code for _, code in found] == [
        "SKU_OLD_001",
        "SKU_001",
        "T",
        "T",
        "SKU_001",
        "SKU_OLD_001",
    ]


def test_plan_months_and_trimming(make):
    plan = make(
        schemas.RAW_PLAN,
        {"month": "2024-12", "region": " R ", "chain_id": " C ", "product_group": "G", "plan_qty": 1},
    )
    found = staging.stg_plan(plan)
    assert found.schema.simpleString() == schemas.STG_PLAN.simpleString()
    assert rows_of(found, "plan_month", "region", "chain_id") == [("2024-12-01", "R", "C")]


def test_empty_strings_become_null_on_request(sales):
    df = sales({"region": "  ", "chain_id": "", "chain_name": "x"})
    assert rows_of(staging.clean_sales(df), "region", "chain_id") == [("", "")]
    assert rows_of(staging.clean_sales(df, empty_as_null=True), "region", "chain_id") == [
        (None, None)
    ]


def test_dated_links_agree_with_trying_each_link(spark, sales, links):
    pick = random.Random(11)

    def day(low, high):
        n = pick.randint(low, high)
        return f"20{n // 360:02}-{n % 360 // 30 + 1:02}-{n % 28 + 1:02}"

    rules = []
    for n in range(120):
        start = pick.choice([None, *[day(0, 9000)] * 9])
        rules.append(
            {
                "old_sku_id": "HOT" if n % 3 == 0 else f"O{pick.randint(0, 5)}",
                "current_sku_id": f"N{n}",
                "valid_from": start,
                "valid_to": pick.choice([None, day(0, 9000), start]),
            }
        )
    sold = [
        {"doc_id": str(n), "sku_id": r["old_sku_id"], "date": day(0, 9000)}
        for n, r in enumerate(pick.choices(rules, k=300))
    ] + [{"doc_id": "x", "sku_id": "OTHER", "date": "2010-01-01"}]

    def current(sale):
        open_end = [{**r, "valid_to": r["valid_to"] or "9999-12-31"} for r in rules]
        valid = [
            r
            for r in open_end
            if r["old_sku_id"] == sale["sku_id"]
            and r["valid_from"]
            and r["valid_from"] <= sale["date"] <= r["valid_to"]
        ]
        order = ("valid_from", "valid_to", "current_sku_id")
        best = max(valid, key=lambda r: tuple(r[c] for c in order), default=None)
        return best["current_sku_id"] if best else sale["sku_id"]

    found = staging.replace_sku_asof(sales(*sold), links(*rules))
    expected = sorted((s["doc_id"], current(s)) for s in sold)
    assert rows_of(found, "doc_id", "sku_id") == expected
    assert any(code.startswith("N") for _, code in expected)
