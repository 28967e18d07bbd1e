"""One ANSI-SQL text per query.

All share a prelude of common table expressions that builds the raw inputs from the star
schema and each layer from the one before; a text is the prelude and one final SELECT.
Decimals and sums leave as DOUBLE, as in the queries.
"""

from __future__ import annotations

SALES_COLUMNS = (
    "doc_id, date, region, chain_id, chain_name, customer_id, sku_id, product_group, qty, "
    "revenue_byn"
)
SERIES = "region, chain_name, product_group"
DOCUMENT_ORDER = (
    "date NULLS LAST, region NULLS LAST, chain_id NULLS LAST, chain_name NULLS LAST, "
    "product_group NULLS LAST, qty NULLS LAST, sku_id NULLS LAST, revenue_byn NULLS LAST"
)
MOVEMENT_ORDER = "date, operation_type, qty, unit_cost_byn, warehouse_name"


def _spread(normaliser: str, kind: str) -> str:
    return f"""
SELECT date, region, chain_id, chain_name, product_group,
       CAST(plan_qty * (day_weight / {normaliser}) AS {kind}) AS plan_qty
FROM (SELECT *, SUM(day_weight) OVER (
        PARTITION BY plan_month, region, chain_id, product_group, chain_name) AS month_weight
      FROM plan_days) AS weighted"""


_PLACES = """
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey
  JOIN region ON r_regionkey = n_regionkey"""

PRELUDE = f"""
WITH raw_sales AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS doc_id,
         CAST(l_shipdate AS DATE) AS date,
         ' ' || r_name || ' ' AS region,
         'CH' || CAST(n_nationkey AS VARCHAR) AS chain_id,
         n_name || ' ' AS chain_name,
         o_custkey AS customer_id,
         chr(160) || CASE WHEN p_size <= 5 THEN 'SKU_OLD_' ELSE 'SKU_' END
           || CAST(l_partkey AS VARCHAR) AS sku_id,
         p_type AS product_group,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END
              AS DECIMAL(12,2)) AS qty,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS revenue_byn
  FROM lineitem JOIN part ON p_partkey = l_partkey {_PLACES}
  LEFT JOIN orders ON o_orderkey = l_orderkey
),
raw_plan AS (
  SELECT strftime(date + INTERVAL 12 MONTH, '%Y-%m') AS month, region, chain_id || ' ' AS chain_id,
         chain_name, product_group,
         greatest(CAST(SUM(qty) AS DOUBLE), 0) AS plan_qty,
         1.0 AS mon_weight, 1.0 AS tue_weight, 1.0 AS wed_weight, 1.0 AS thu_weight,
         1.0 AS fri_weight, 0.55 AS sat_weight, 0.25 AS sun_weight
  FROM raw_sales GROUP BY ALL
),
raw_sku_links AS (
  SELECT 'SKU_OLD_' || CAST(p_partkey AS VARCHAR) AS old_sku_id,
         'SKU_' || CAST(p_partkey AS VARCHAR) AS current_sku_id,
         CASE WHEN p_size <= 2 THEN DATE '1996-01-01' ELSE DATE '1998-01-01' END AS valid_from,
         CASE WHEN p_size IN (1, 3) THEN DATE '1999-12-31' END AS valid_to
  FROM part WHERE p_size <= 5
),
link_history AS (
  SELECT * FROM raw_sku_links
  UNION ALL
  SELECT old_sku_id, current_sku_id || '_T', DATE '1999-01-01', DATE '1999-06-30'
  FROM raw_sku_links
),
raw_stock AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         'WH' || CAST(l_suppkey AS VARCHAR) AS warehouse_id,
         s_name || ' ' AS warehouse_name,
         'SKU_' || p_brand AS sku_id,
         CASE WHEN l_returnflag = 'R' THEN 'adjust' WHEN l_linestatus = 'F' THEN ' income'
              ELSE 'outcome ' END AS operation_type,
         CAST(l_quantity AS DECIMAL(12,2)) AS qty,
         CAST(p_retailprice AS DECIMAL(12,2)) AS unit_cost_byn
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
),
cleaned AS (
  SELECT doc_id, date, trim(region) AS region, chain_id, trim(chain_name) AS chain_name,
         customer_id, trim(sku_id) AS sku_id, trim(product_group) AS product_group, qty, revenue_byn
  FROM raw_sales
),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY {DOCUMENT_ORDER}) AS rn FROM cleaned
),
documents_once AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1),
stg_sales AS (
  SELECT d.* REPLACE (COALESCE(l.current_sku_id, d.sku_id) AS sku_id)
  FROM documents_once d LEFT JOIN raw_sku_links l ON d.sku_id = l.old_sku_id
),
stg_sales_asof AS (
  SELECT doc_id, date, COALESCE(current_sku_id, sku_id) AS sku_id
  FROM (SELECT d.doc_id, d.date, d.sku_id, l.current_sku_id, ROW_NUMBER() OVER (
          PARTITION BY d.doc_id
          ORDER BY l.valid_from DESC NULLS LAST,
                   COALESCE(l.valid_to, DATE '9999-12-31') DESC, l.current_sku_id DESC) AS pick
        FROM documents_once d LEFT JOIN link_history l
          ON d.sku_id = l.old_sku_id AND l.valid_from <= d.date
          AND (l.valid_to IS NULL OR d.date <= l.valid_to)) AS candidates
  WHERE pick = 1
),
stg_plan AS (
  SELECT trim(chain_id) AS chain_id, trim(region) AS region, trim(product_group) AS product_group,
         trim(chain_name) AS chain_name,
         CAST(month || '-01' AS DATE) AS plan_month,
         CAST(plan_qty AS FLOAT) AS plan_qty,
         CAST(mon_weight AS FLOAT) AS mon_weight, CAST(tue_weight AS FLOAT) AS tue_weight,
         CAST(wed_weight AS FLOAT) AS wed_weight, CAST(thu_weight AS FLOAT) AS thu_weight,
         CAST(fri_weight AS FLOAT) AS fri_weight, CAST(sat_weight AS FLOAT) AS sat_weight,
         CAST(sun_weight AS FLOAT) AS sun_weight
  FROM raw_plan
),
plan_days AS (
  SELECT CAST(day AS DATE) AS date, plan_month, region, chain_id, chain_name, product_group,
         CAST(plan_qty AS DOUBLE) AS plan_qty,
         CAST(CASE isodow(day) WHEN 1 THEN mon_weight WHEN 2 THEN tue_weight
              WHEN 3 THEN wed_weight WHEN 4 THEN thu_weight WHEN 5 THEN fri_weight
              WHEN 6 THEN sat_weight ELSE sun_weight END AS DOUBLE) AS day_weight,
         CAST(mon_weight AS DOUBLE) + CAST(tue_weight AS DOUBLE) + CAST(wed_weight AS DOUBLE)
           + CAST(thu_weight AS DOUBLE) + CAST(fri_weight AS DOUBLE)
           + CAST(sat_weight AS DOUBLE) + CAST(sun_weight AS DOUBLE) AS week_weight
  FROM (SELECT *, unnest(generate_series(plan_month, last_day(plan_month), INTERVAL 1 DAY)) AS day
        FROM stg_plan) AS days
),
plan_daily AS ({_spread("month_weight", "FLOAT")}),
plan_daily_exact AS ({_spread("month_weight", "DOUBLE")}),
plan_daily_week AS ({_spread("week_weight", "FLOAT")}),
sales_daily AS (
  SELECT date, region, chain_id, chain_name, product_group, SUM(qty) AS actual_qty
  FROM stg_sales GROUP BY ALL
),
plan_daily_agg AS (
  SELECT date, region, chain_id, product_group, SUM(CAST(plan_qty AS DOUBLE)) AS plan_qty,
         MIN(chain_name) AS plan_chain_name
  FROM plan_daily GROUP BY date, region, chain_id, product_group
),
mart_full AS (
  SELECT date, region, chain_id, product_group, chain_name, plan_chain_name,
         CAST(COALESCE(actual_qty, 0) AS DOUBLE) AS actual_qty, COALESCE(plan_qty, 0) AS plan_qty
  FROM sales_daily FULL JOIN plan_daily_agg USING (date, region, chain_id, product_group)
),
mart AS (
  SELECT *, actual_qty - plan_qty AS delta,
         ROUND(actual_qty / NULLIF(plan_qty, 0) * 100, 2) AS completion_pct
  FROM mart_full
),
last_operation AS (
  SELECT customer_id, doc_id AS last_doc_id, date AS last_date, sku_id AS last_sku_id,
         CAST(qty AS DOUBLE) AS last_qty, CAST(revenue_byn AS DOUBLE) AS last_revenue_byn
  FROM stg_sales
  QUALIFY ROW_NUMBER() OVER (
    PARTITION BY customer_id ORDER BY date DESC NULLS LAST, doc_id DESC NULLS LAST) = 1
),
rolling AS (
  SELECT date, {SERIES}, CAST(actual_qty AS DOUBLE) AS actual_qty,
         CAST(SUM(actual_qty) OVER last_seven AS DOUBLE) AS rolling_7d_actual_qty
  FROM sales_daily
  WINDOW last_seven AS (PARTITION BY {SERIES} ORDER BY date, chain_id ROWS 6 PRECEDING)
),
mtd AS (
  SELECT date, {SERIES}, CAST(actual_qty AS DOUBLE) AS actual_qty,
         CAST(SUM(actual_qty) OVER so_far AS DOUBLE) AS mtd_actual_qty
  FROM sales_daily
  WINDOW so_far AS (PARTITION BY {SERIES}, year(date), month(date) ORDER BY date, chain_id
                    ROWS UNBOUNDED PRECEDING)
),
stg_stock AS (
  SELECT date, trim(warehouse_id) AS warehouse_id, trim(warehouse_name) AS warehouse_name,
         trim(sku_id) AS sku_id, trim(operation_type) AS operation_type, qty, unit_cost_byn
  FROM raw_stock
),
stock_changes AS (
  SELECT *, qty * CASE operation_type WHEN 'income' THEN 1 WHEN 'outcome' THEN -1 ELSE 0 END
            AS change
  FROM stg_stock
),
stock AS (
  SELECT date, warehouse_id, warehouse_name, sku_id, CAST(balance AS DOUBLE) AS stock_qty,
         CAST(ROUND(balance * unit_cost_byn, 2) AS DOUBLE) AS stock_value_byn
  FROM (SELECT *, SUM(change) OVER moves AS balance FROM stock_changes
        WINDOW moves AS (PARTITION BY warehouse_id, sku_id ORDER BY {MOVEMENT_ORDER}
                         ROWS UNBOUNDED PRECEDING)) AS balances
  WHERE balance <> 0
),
stock_days AS (
  SELECT date, warehouse_id, warehouse_name, sku_id, CAST(stock_qty AS DOUBLE) AS stock_qty,
         CAST(ROUND(stock_qty * unit_cost_byn, 2) AS DOUBLE) AS stock_value_byn
  FROM (SELECT *,
          SUM(change) OVER (PARTITION BY warehouse_id, sku_id ORDER BY date
            RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stock_qty,
          ROW_NUMBER() OVER (PARTITION BY warehouse_id, sku_id, date
            ORDER BY operation_type DESC, qty DESC, unit_cost_byn DESC, warehouse_name DESC)
            AS from_last
        FROM stock_changes) AS balance
  WHERE from_last = 1 AND stock_qty <> 0
),
mtd_starts AS (
  SELECT {SERIES}, date_trunc('month', date) AS month, date,
         abs(mtd_actual_qty - actual_qty) AS gap,
         ROW_NUMBER() OVER (PARTITION BY {SERIES}, date_trunc('month', date)
           ORDER BY date, abs(mtd_actual_qty - actual_qty)) AS rn
  FROM mtd
)
"""


def _plan_totals(daily: str, only_off_by: float | None = None) -> str:
    """Months beside their days, joined day by day; optionally only those that differ."""
    off = "" if only_off_by is None else f"HAVING ABS(SUM(day_qty) - month_qty) > {only_off_by}"
    return f"""
SELECT plan_month, chain_id, region, product_group, month_qty AS monthly_plan,
       ROUND(SUM(day_qty), 4) AS sum_daily_plan, ROUND(SUM(day_qty) - month_qty, 4) AS diff
FROM (SELECT plan_month, chain_id, region, product_group, CAST(plan_qty AS DOUBLE) AS month_qty
      FROM stg_plan) AS months
JOIN (SELECT CAST(date_trunc('month', date) AS DATE) AS plan_month, chain_id, region,
             product_group, CAST(plan_qty AS DOUBLE) AS day_qty
      FROM {daily}) AS days USING (plan_month, chain_id, region, product_group)
GROUP BY plan_month, chain_id, region, product_group, month_qty {off}"""


_TOLERANCE = 0.01
_SALES_OUT = SALES_COLUMNS.replace(
    "qty, revenue_byn", "CAST(qty AS DOUBLE) AS qty, CAST(revenue_byn AS DOUBLE) AS revenue_byn"
)
_MART_OUT = (
    "date, region, chain_id, {name} AS chain_name, product_group, actual_qty, "
    "ROUND(plan_qty, 6) AS plan_qty, ROUND(delta, 6) AS delta, completion_pct"
)
_PLAN_OUT = "date, region, chain_id, product_group, ROUND(CAST(plan_qty AS DOUBLE), 6) AS plan_qty"
_PLAN_COLUMNS = (
    "chain_id, region, product_group, plan_month, plan_qty, mon_weight, tue_weight, wed_weight, "
    "thu_weight, fri_weight, sat_weight, sun_weight"
)
_NULL_KEYS = "date IS NULL OR region IS NULL OR chain_id IS NULL OR product_group IS NULL"


def _check(name: str, n_bad: str, informative: bool = False) -> str:
    passed = "TRUE" if informative else "n_bad = 0"
    return f"SELECT '{name}' AS \"check\", n_bad, {passed} AS passed FROM ({n_bad}) AS c"


def _count(rows: str) -> str:
    return f"SELECT CAST(COUNT(*) AS BIGINT) AS n_bad FROM ({rows}) AS r"


_DUP_DOCS = (
    "SELECT doc_id, COUNT(*) AS dup_count FROM raw_sales GROUP BY doc_id HAVING COUNT(*) > 1"
)
_DUP_KEYS = (
    "SELECT date, region, chain_id, product_group, COUNT(*) AS dup_count FROM mart "
    "GROUP BY 1, 2, 3, 4 HAVING COUNT(*) > 1"
)
_OLD_LEFT = (
    "SELECT COUNT(DISTINCT sku_id) AS {name} FROM stg_sales "
    "WHERE sku_id IN (SELECT old_sku_id FROM raw_sku_links)"
)
_MTD_BREAKS = (
    f"SELECT {SERIES}, CAST(month AS DATE) AS month, date, gap FROM mtd_starts "
    "WHERE rn = 1 AND gap <> 0"
)

_PLAN_COVERAGE = """
SELECT plan_month, chain_id, region, product_group, SUM(p)::BIGINT AS n_plan_rows,
       SUM(d)::BIGINT AS n_day_rows, (SUM(p) * day(last_day(plan_month)))::BIGINT AS n_expected
FROM (SELECT plan_month, chain_id, region, product_group, 1 AS p, 0 AS d FROM stg_plan
      UNION ALL
      SELECT CAST(date_trunc('month', date) AS DATE), chain_id, region, product_group, 0, 1
      FROM plan_daily WHERE {days}) AS sides
GROUP BY plan_month, chain_id, region, product_group
HAVING n_day_rows <> n_expected OR n_plan_rows = 0"""

_END = "COALESCE(valid_to, DATE '9999-12-31')"
_LINK_OVERLAPS = f"""
SELECT old_sku_id, current_sku_id, valid_from, valid_to,
       NULLIF(reach, DATE '9999-12-31') AS covered_to
FROM (SELECT *, MAX({_END}) OVER (
        PARTITION BY old_sku_id ORDER BY valid_from, {_END}, current_sku_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
      FROM link_history WHERE valid_from <= {_END}) AS swept
WHERE valid_from <= reach"""
_LINK_CHAINS = """
SELECT code AS old_sku_id, CASE WHEN circle IS NULL THEN reached END AS final_sku_id,
       CASE WHEN circle IS NULL THEN n WHEN reached = code THEN len(circle) END::BIGINT AS n_steps,
       CASE WHEN circle IS NOT NULL THEN CASE WHEN reached = code THEN 'cycle' ELSE 'into_cycle' END
            WHEN n = 1 THEN 'direct' ELSE 'chain' END AS status,
       list_min(circle) AS cycle_id
FROM (
  WITH RECURSIVE step AS (
    SELECT 'SKU_' || CAST(p_partkey AS VARCHAR) AS code,
           'SKU_' || CAST(CASE WHEN p_size <= 5 AND p_partkey > 100
                               THEN p_partkey * 3 ELSE p_partkey // 3 END
                          AS VARCHAR) AS next
    FROM part WHERE p_partkey > 0
  ),
  walk AS (
    SELECT code, next AS reached, [code] AS path FROM step
    UNION ALL
    SELECT w.code, s.next, list_append(w.path, w.reached)
    FROM walk w JOIN step s ON s.code = w.reached WHERE NOT list_contains(w.path, w.reached)
  )
  SELECT code, reached, len(path) AS n,
         CASE WHEN list_contains(path, reached)
              THEN path[list_position(path, reached):] END AS circle
  FROM walk
  WHERE list_contains(path, reached) OR reached NOT IN (SELECT code FROM step)
) AS walked"""

_FINALS = {
    "stg_sales": f"SELECT {_SALES_OUT} FROM stg_sales",
    "stg_sku_links": (
        "SELECT trim(old_sku_id) AS old_sku_id, trim(current_sku_id) AS current_sku_id, "
        "valid_from, valid_to FROM raw_sku_links"
    ),
    "link_overlaps": _LINK_OVERLAPS,
    "link_chains": _LINK_CHAINS,
    "stg_plan": f"SELECT {_PLAN_COLUMNS} FROM stg_plan",
    "stg_stock_movements": (
        "SELECT date, warehouse_id, warehouse_name, sku_id, operation_type, "
        "CAST(qty AS DOUBLE) AS qty, CAST(unit_cost_byn AS DOUBLE) AS unit_cost_byn FROM stg_stock"
    ),
    "dup_documents": _DUP_DOCS,
    "dup_documents_quarantine": (
        f"SELECT {_SALES_OUT} FROM ranked WHERE rn > 1"
    ),
    "sku_replace_asof": "SELECT doc_id, date, sku_id FROM stg_sales_asof",
    "sales_with_catalog": (
        "SELECT doc_id, sku_id, CAST(qty AS DOUBLE) AS qty, p_name AS sku_name, "
        "p_retailprice AS base_price_byn FROM stg_sales "
        "LEFT JOIN part ON sku_id = 'SKU_' || CAST(p_partkey AS VARCHAR)"
    ),
    "plan_daily": f"SELECT {_PLAN_OUT} FROM plan_daily",
    "plan_daily_exact": f"SELECT {_PLAN_OUT} FROM plan_daily_exact",
    "plan_daily_weekly_norm": f"SELECT {_PLAN_OUT} FROM plan_daily_week",
    "sales_daily": (
        "SELECT date, region, chain_id, chain_name, product_group, "
        "CAST(actual_qty AS DOUBLE) AS actual_qty FROM sales_daily"
    ),
    "plan_daily_agg": f"SELECT {_PLAN_OUT} FROM plan_daily_agg",
    "mart_sales_plan_daily": (
        "SELECT " + _MART_OUT.format(name="COALESCE(chain_name, '')") + " FROM mart"
    ),
    "mart_sales_plan_named": (
        "SELECT "
        + _MART_OUT.format(name="COALESCE(chain_name, plan_chain_name, '')")
        + " FROM mart"
    ),
    "mart_summary": (
        "SELECT MIN(date) AS first_date, MAX(date) AS last_date, "
        "SUM(actual_qty) AS total_actual, ROUND(SUM(plan_qty), 3) AS total_plan, "
        "COUNT(*) AS n_rows FROM mart"
    ),
    "mart_sample": (
        "SELECT date, region, chain_id, product_group, actual_qty, ROUND(plan_qty, 6) AS plan_qty, "
        "ROUND(delta, 6) AS delta, completion_pct FROM mart WHERE actual_qty > 0 OR plan_qty > 0 "
        "ORDER BY date, region, chain_id, product_group, COALESCE(chain_name, '') LIMIT 10"
    ),
    "last_customer_operation": "SELECT * FROM last_operation",
    "last_operation_sample": (
        "SELECT * FROM last_operation ORDER BY customer_id NULLS LAST LIMIT 5"
    ),
    "rolling_7_rows": "SELECT * FROM rolling",
    "rolling_7_rows_by_ranges": "SELECT * FROM rolling",
    "rolling_7_days": (
        f"SELECT date, {SERIES}, CAST(actual_qty AS DOUBLE) AS actual_qty, "
        f"CAST(SUM(actual_qty) OVER (PARTITION BY {SERIES} ORDER BY date "
        "RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS DOUBLE) "
        "AS rolling_7d_actual_qty FROM sales_daily"
    ),
    "rolling_region_top5": (
        "SELECT * FROM rolling WHERE region = 'ASIA' "
        "ORDER BY date, chain_name, product_group, actual_qty, rolling_7d_actual_qty LIMIT 5"
    ),
    "mtd": "SELECT * FROM mtd",
    "mtd_by_ranges": "SELECT * FROM mtd",
    "mtd_region_top5": (
        "SELECT * FROM mtd WHERE region = 'ASIA' "
        "ORDER BY date, chain_name, product_group, actual_qty, mtd_actual_qty LIMIT 5"
    ),
    "mtd_first_week_region": (
        "SELECT * FROM mtd WHERE region = 'ASIA' AND date BETWEEN '1997-01-01' AND '1997-01-07'"
    ),
    "stock_per_movement": "SELECT * FROM stock",
    "stock_per_movement_by_ranges": "SELECT * FROM stock",
    "stock_end_of_day": "SELECT * FROM stock_days",
    "stock_sample": (
        "SELECT * FROM stock "
        "ORDER BY warehouse_id, sku_id, date, stock_qty, stock_value_byn LIMIT 5"
    ),
    "plan_month_totals": _plan_totals("plan_daily"),
    "check_plan_sum": _plan_totals("plan_daily", _TOLERANCE),
    "plan_days_of_months": _PLAN_COVERAGE.format(days="day(date) <> 31"),
    "check_plan_days": _PLAN_COVERAGE.format(days="TRUE"),
    "check_plan_sum_weekly_norm": _plan_totals("plan_daily_week", _TOLERANCE),
    "check_plan_sum_range": """
SELECT chain_id, region, product_group, plan_month, monthly_plan,
       ROUND(SUM(day_qty), 2) AS sum_daily, COUNT(date) AS days_in_plan,
       day(last_day(plan_month)) AS days_in_month
FROM (SELECT chain_id, region, product_group, plan_month, CAST(plan_qty AS DOUBLE) AS monthly_plan
      FROM stg_plan) AS months
JOIN (SELECT chain_id, region, product_group, date, CAST(plan_qty AS DOUBLE) AS day_qty
      FROM plan_daily) AS days USING (chain_id, region, product_group)
WHERE date BETWEEN plan_month AND last_day(plan_month)
GROUP BY chain_id, region, product_group, plan_month, monthly_plan""",
    "check_old_sku": _OLD_LEFT.format(name="n_old_skus"),
    "old_skus_in_raw": (
        "SELECT DISTINCT sku_id FROM cleaned "
        "WHERE sku_id IN (SELECT old_sku_id FROM raw_sku_links)"
    ),
    "old_skus_left_asof": (
        "SELECT DISTINCT sku_id FROM stg_sales_asof "
        "WHERE sku_id IN (SELECT old_sku_id FROM link_history)"
    ),
    "check_mart_keys": _DUP_KEYS,
    "check_null_profile": (
        "SELECT COUNT(*) AS total, "
        + ", ".join(
            f"COUNT(*) FILTER (WHERE {k} IS NULL) AS null_{k}"
            for k in ("date", "region", "chain_id", "product_group")
        )
        + f", COUNT(*) FILTER (WHERE {_NULL_KEYS}) AS null_keys FROM mart"
    ),
    "check_returns": (
        "SELECT COUNT(*) AS n_returns, CAST(ROUND(SUM(qty), 0) AS DOUBLE) AS returned_qty "
        "FROM stg_sales WHERE qty < 0"
    ),
    "check_negative_stock": "SELECT * FROM stock WHERE stock_qty < 0",
    "check_mtd_first_day": _MTD_BREAKS,
    "check_report": " UNION ALL ".join(
        [
            _check("duplicate_documents", _count(_DUP_DOCS), informative=True),
            _check("plan_sum", _count(_plan_totals("plan_daily", _TOLERANCE))),
            _check("plan_days", _count(_PLAN_COVERAGE.format(days="TRUE"))),
            _check("old_sku", _OLD_LEFT.format(name="n_bad")),
            _check("duplicate_mart_keys", _count(_DUP_KEYS)),
            _check("null_mart_keys", _count(f"SELECT 1 FROM mart WHERE {_NULL_KEYS}")),
            _check("returns", _count("SELECT 1 FROM stg_sales WHERE qty < 0"), informative=True),
            _check("mtd_first_day", _count(_MTD_BREAKS)),
            _check("negative_stock", _count("SELECT 1 FROM stock WHERE stock_qty < 0")),
        ]
    ),
    "layer_counts": " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS \"table\", COUNT(*) AS n_rows FROM {source}"
        for layer, name, source in (
            ("raw", "raw_sales", "raw_sales"),
            ("raw", "raw_plan", "raw_plan"),
            ("raw", "raw_sku_links", "raw_sku_links"),
            ("raw", "raw_stock_movements", "raw_stock"),
            ("stg", "stg_sales", "stg_sales"),
            ("stg", "stg_plan_daily", "plan_daily"),
            ("mart", "mart_sales_plan_daily", "mart"),
            ("mart", "mart_last_customer_operation", "last_operation"),
            ("mart", "mart_rolling_7d", "rolling"),
            ("mart", "mart_mtd", "mtd"),
            ("mart", "mart_stock_daily", "stock"),
        )
    ),
}

ORACLES = {name: PRELUDE + final for name, final in _FINALS.items()}
