"""Declared schemas: raw inputs, staging tables and marts."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
TOTAL = T.DecimalType(38, 2)

# Monday to Sunday, the order in which ``weekday()`` numbers the days.
WEIGHTS = [
    "mon_weight",
    "tue_weight",
    "wed_weight",
    "thu_weight",
    "fri_weight",
    "sat_weight",
    "sun_weight",
]


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _D, _F, _DBL, _L = (
    T.StringType(),
    T.DateType(),
    T.FloatType(),
    T.DoubleType(),
    T.LongType(),
)

RAW_SALES = _struct(
    ("doc_id", _S),
    ("date", _D),
    ("region", _S),
    ("chain_id", _S),
    ("chain_name", _S),
    ("customer_id", _S),
    ("sku_id", _S),
    ("product_group", _S),
    ("qty", MONEY),
    ("revenue_byn", MONEY),
)

RAW_PLAN = _struct(
    ("month", _S),
    ("region", _S),
    ("chain_id", _S),
    ("chain_name", _S),
    ("product_group", _S),
    ("plan_qty", _DBL),
    *[(w, _DBL) for w in WEIGHTS],
)

RAW_SKU_LINKS = _struct(
    ("old_sku_id", _S),
    ("current_sku_id", _S),
    ("valid_from", _D),
    ("valid_to", _D),
)

RAW_STOCK_MOVEMENTS = _struct(
    ("date", _D),
    ("warehouse_id", _S),
    ("warehouse_name", _S),
    ("sku_id", _S),
    ("operation_type", _S),
    ("qty", MONEY),
    ("unit_cost_byn", MONEY),
)

RAW_CATALOG = _struct(
    ("sku_id", _S),
    ("sku_name", _S),
    ("product_group", _S),
    ("base_price_byn", _DBL),
)

STG_SALES = _struct(
    ("doc_id", _S),
    ("date", _D),
    ("customer_id", _S),
    ("region", _S),
    ("chain_id", _S),
    ("chain_name", _S),
    ("sku_id", _S),
    ("product_group", _S),
    ("qty", MONEY),
    ("revenue_byn", MONEY),
)

STG_PLAN = _struct(
    ("chain_id", _S),
    ("region", _S),
    ("product_group", _S),
    ("plan_month", _D),
    ("plan_qty", _F),
    *[(w, _F) for w in WEIGHTS],
)

STG_PLAN_DAILY = _struct(
    ("date", _D),
    ("region", _S),
    ("chain_id", _S),
    ("product_group", _S),
    ("plan_qty", _F),
)

SALES_DAILY = _struct(
    ("date", _D),
    ("region", _S),
    ("chain_id", _S),
    ("chain_name", _S),
    ("product_group", _S),
    ("actual_qty", TOTAL),
)

PLAN_DAILY_AGG = _struct(
    ("date", _D),
    ("region", _S),
    ("chain_id", _S),
    ("product_group", _S),
    ("plan_qty", _DBL),
)

MART_SALES_PLAN = _struct(
    ("date", _D),
    ("region", _S),
    ("chain_id", _S),
    ("chain_name", _S),
    ("product_group", _S),
    ("actual_qty", TOTAL),
    ("plan_qty", _DBL),
    ("delta", _DBL),
    ("completion_pct", _DBL),
)

MART_STOCK = _struct(
    ("date", _D),
    ("warehouse_id", _S),
    ("warehouse_name", _S),
    ("sku_id", _S),
    ("stock_qty", TOTAL),
    ("stock_value_byn", TOTAL),
)

CHECK_REPORT = _struct(("check", _S), ("n_bad", _L), ("passed", T.BooleanType()))
