"""Oracle SQL of the data checks."""

from __future__ import annotations

import re

from oracle import layers as L
from oracle.ctes import AS_OF, m
from tillhouse.context import DEFAULT
from tillhouse.plans import suites

ORACLE: dict[str, str] = {}
o = ORACLE


def row(name: str, count: str, rest: str, severity: str = "error", warn: int = 0, error: int = 0) -> str:
    text = name.replace("'", "''")
    fail = f"WHEN n > {error} THEN 'fail' " if severity == "error" else ""
    return f"SELECT '{text}' AS \"check\", n AS failures, CASE {fail}WHEN n > {warn} THEN 'warn' ELSE 'pass' END AS status FROM (SELECT {count} AS n {rest})"


def rows(*parts: str) -> str:
    return "\nUNION ALL ".join(parts)


def count_of(table: str, test: str) -> tuple[str, str]:
    return "COUNT(*)", f"FROM {table} WHERE {test}"


def repeated(table: str, cols: str, where: str = "TRUE") -> tuple[str, str]:
    return "COUNT(*)", f"FROM (SELECT 1 FROM {table} WHERE {where} GROUP BY {cols} HAVING COUNT(*) > 1)"


T, C = "raw_transactions", "raw_customers"
o["dq1_not_null"] = rows(
    row("not_null(customer_id)", *count_of(T, "customer_id IS NULL")), row("not_null(date)", *count_of(T, "date IS NULL"), "warn"),
    row("not_null(product_id)", *count_of(T, "product_id IS NULL"), "warn", 1000), row("not_null(store_id)", *count_of(T, "store_id IS NULL")),
)
o["dq2_unique"] = rows(
    row("unique(product_id)", *repeated("raw_products", "product_id")), row("unique(sku)", *repeated("raw_products", "sku", "sku IS NOT NULL"), "warn"),
)
o["dq3_unique_combination"] = rows(
    row("unique(l_orderkey, l_linenumber)", *repeated("lineitem", "l_orderkey, l_linenumber")),
    row("unique(l_orderkey, l_partkey)", *repeated("lineitem", "l_orderkey, l_partkey"), "warn", 10),
)
o["dq4_accepted_values"] = rows(
    row("accepted_values(gender)", *count_of(C, "gender NOT IN ('Male', 'Female', 'Other')"), "warn"),
    row("accepted_values(loyalty_member)", *count_of(C, "FALSE")),
    row("accepted_values(state)", *count_of(C, "state <> 'NATION_1' AND state <> 'NATION_2'")),
)
o["dq5_accepted_range"] = rows(
    row("accepted_range(l_quantity)", *count_of("lineitem", "l_quantity NOT BETWEEN 1 AND 45")),
    row("accepted_range(l_extendedprice)", *count_of("lineitem", "l_extendedprice > 100000"), "warn"),
    row("accepted_range(l_discount)", *count_of("lineitem", "l_returnflag = 'R' AND l_discount < 0.01::DOUBLE")),
)
o["dq6_expression"] = rows(
    row("expression(o_totalprice > 1000)", *count_of("orders", "o_totalprice <= 1000 OR o_totalprice IS NULL")),
    row("expression(o_orderdate >= timestamp_ntz'1996-01-01 00:00:00')", *count_of("orders", "o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1996-01-01'"), "warn"),
)
o["dq7_relationships"] = row(
    "foreign_key(product_id -> stg_products.product_id)",
    *count_of(T, "product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM stg_products)"), "warn",
)
o["dq8_not_empty_string"] = rows(
    row("not_empty_string(email)", *count_of(C, "TRIM(email) = ''")), row("not_empty_string(city)", *count_of(C, "TRIM(city) = ''"), "warn"),
    row("not_empty_string(zip_code)", *count_of(C, "TRIM(zip_code) = ''")),
)
o["dq9_recency"] = rows(*[
    row(f"recency(l_shipdate, {d}d)", f"CASE WHEN MAX(l_shipdate) >= TIMESTAMP '2001-12-31 06:00:00' - INTERVAL {d} DAY THEN 0::BIGINT ELSE 1::BIGINT END", "FROM lineitem", s)
    for d, s in ((100, "error"), (2, "warn"))
])
o["dq10_match_regex"] = row("match_regex(email)", *count_of(C, r"NOT regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')"), "warn", 50)
o["dq11_value_length"] = rows(
    row("value_length(lang)", *count_of("documents", "LENGTH(lang) <> 2")),
    row("value_length(text)", *count_of("documents", "LENGTH(text) < 50 OR LENGTH(text) > 5000"), "warn", 5),
    row("value_length(source)", *count_of("documents", "lang = 'en' AND LENGTH(source) <> 4")),
)
o["dq12_freshness"] = """
SELECT newest, age AS age_hours, CASE WHEN age > 48 THEN 'fail' WHEN age > 24 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT MAX(o_orderdate) AS newest, date_sub('hour', MAX(o_orderdate), TIMESTAMP '2001-08-02 12:00:00') AS age FROM orders)"""
_q = count_of("lineitem", "l_quantity NOT BETWEEN 1 AND 45")
o["dq13_severity_and_thresholds"] = rows(row("strict", *_q), row("lenient", *_q, error=10**9), row("silent", *_q, severity="warn", warn=10**9))
o["dq14_profit_identity"] = """
SELECT sales_key, product_key, 'Profit calculation mismatch!' AS error_message FROM fact_sales
WHERE total_cost > 0 AND line_total <> 0 AND NOT is_refund AND ABS(line_profit - (line_total - total_cost)) > 0.02::DOUBLE"""
o["dq15_positive_sales"] = """
SELECT * FROM (SELECT sales_key, quantity, unit_price, CASE WHEN line_total <= 0 THEN 'Line total should be positive' WHEN quantity <= 0 THEN 'Quantity should be positive'
  WHEN unit_price <= 0 THEN 'Unit price should be positive' END AS error_reason FROM fact_sales WHERE NOT is_refund) WHERE error_reason IS NOT NULL"""
o["dq16_calendar_gaps"] = """
SELECT CAST(DATE '1995-01-01' + CAST(n AS INTEGER) AS DATE) AS expected_date, 'MISSING DATE!' AS error_message FROM (SELECT UNNEST(generate_series(
  LEAST(0, (SELECT date_diff('day', DATE '1995-01-01', MIN(o_orderdate)) FROM orders)), GREATEST(2403, (SELECT date_diff('day', DATE '1995-01-01', MAX(o_orderdate)) FROM orders)))) AS n)
WHERE DATE '1995-01-01' + CAST(n AS INTEGER) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderdate IS NOT NULL)"""
o["dq17_duplicate_lines"] = "SELECT transaction_id_clean, product_id, COUNT(*) AS duplicate_count FROM stg_transactions GROUP BY ALL HAVING COUNT(*) > 1"
_d = m("ABS(subtotal + tax_amount - total_amount)")
o["dq18_transaction_math"] = f"SELECT transaction_id_clean, total_amount, {_d} AS difference FROM stg_transactions WHERE {_d} > 0.01::DOUBLE"
o["dq19_refund_reason"] = """
SELECT transaction_id_clean, payment_status, refund_reason FROM stg_transactions
WHERE payment_status = 'REFUNDED' AND COALESCE(TRIM(refund_reason), '') = ''"""
o["dq20_payment_share_band"] = """
SELECT o_orderpriority AS payment_method FROM orders GROUP BY 1 HAVING COUNT(*) * 100.0::DOUBLE / (SELECT COUNT(*) FROM orders) NOT BETWEEN 20 AND 80"""
o["dq21_composite_key"] = rows(
    row("unique(transaction_id, product_id)", *repeated("intmd_transactions", "transaction_id, product_id")),
    row("unique(line_item_key)", *repeated("intmd_transactions", "line_item_key")),
)
o["dq22_flags_agree"] = """
SELECT * FROM (SELECT transaction_id, product_id, CONCAT_WS(',', CASE WHEN has_promotion <> (COALESCE(TRIM(promotion_code), '') <> '') THEN 'has_promotion' END,
  CASE WHEN is_refund <> (payment_status = 'REFUNDED' OR refund_reason IS NOT NULL) THEN 'is_refund' END,
  CASE WHEN is_weekend <> (dayofweek(transaction_date) IN (0, 6)) THEN 'is_weekend' END) AS flags FROM intmd_transactions) WHERE flags <> ''"""
o["dq23_discount_recomputed"] = """
SELECT transaction_id_raw, product_id, discount_amount FROM stg_transactions
WHERE ABS(discount_amount - quantity * unit_price * (discount_percent / 100)) > 0.01::DOUBLE"""
o["dq23_age_recomputed"] = f"""
SELECT customer_id, age, CAST(date_sub('year', date_of_birth, {AS_OF}) AS INTEGER) AS completed_years FROM stg_customers WHERE age <> date_sub('year', date_of_birth, {AS_OF})"""
_mm = L.margin_pct("selling_price", "cost_price")
o["dq23_margin_recomputed"] = f"""
SELECT product_id, profit_margin_pct, {_mm} AS recomputed FROM stg_products WHERE ABS(profit_margin_pct - ({_mm})) > 0"""
o["dq23_years_recomputed"] = """
SELECT store_id, years_since_opening, days_since_opening FROM stg_stores WHERE ABS(years_since_opening - days_since_opening / 365.0::DOUBLE) > 0.4::DOUBLE"""
o["dq23_line_total_recomputed"] = """
SELECT line_item_key FROM intmd_transactions WHERE ABS(line_total_clean - CASE WHEN line_total < 0 AND NOT is_refund THEN 0
  WHEN line_total = 0 AND quantity > 0 AND unit_price > 0 THEN quantity * unit_price * (1 - discount_percent / 100) ELSE line_total END) > 0.02::DOUBLE"""
o["dq24_positive_refunds"] = "SELECT line_item_key, line_total_clean FROM intmd_transactions WHERE is_refund AND line_total_clean > 0"
o["dq25_email_unique"] = "SELECT email, COUNT(*) AS n FROM stg_customers WHERE email IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1"
o["dq25_store_name_unique_in_city"] = "SELECT store_name, city, COUNT(*) AS n FROM stg_stores GROUP BY ALL HAVING COUNT(*) > 1"
o["dq26_labels_agree"] = f"""
SELECT customer_id AS id, 'state' AS label, state AS stored, state_name_from_zip AS expected FROM intmd_customers WHERE state <> state_name_from_zip
UNION ALL SELECT product_id, 'weight_category', weight_category, {L.weight_incl('weight')} FROM stg_products WHERE weight_category <> {L.weight_incl('weight')}
UNION ALL SELECT customer_id, 'quality_tier', quality_tier, t FROM (SELECT *, CASE WHEN quality_issues_count > 2 THEN 'POOR'
  WHEN quality_issues_count > 0 THEN 'ACCEPTABLE' ELSE 'CLEAN' END AS t FROM intmd_customers) WHERE quality_tier <> t
UNION ALL SELECT store_id, 'region', region, {L.region('state')} FROM intmd_stores WHERE region <> {L.region('state')}
UNION ALL SELECT store_id, 'store_category', store_category, {L.store_category('store_type')} FROM intmd_stores WHERE store_category <> {L.store_category('store_type')}"""
o["dq27_domain"] = f"""
SELECT product_id AS id, 'cost_exceeds_price' AS violation FROM stg_products WHERE cost_price > selling_price
UNION ALL SELECT product_id, 'negative_stock' FROM stg_products WHERE stock_quantity_raw < 0
UNION ALL SELECT store_id, 'future_opening' FROM stg_stores WHERE opening_date > {AS_OF}"""


def duck(text: str) -> str:
    """A check's condition in DuckDB's dialect."""
    text = re.sub(r"not (\w+) rlike r('[^']*')", r"not regexp_matches(\1, \2)", text)
    text = re.sub(r"add_months\((date'[^']*'), (-?\d+)\)", r"(\1 + INTERVAL (\2) MONTH)", text)
    return text.replace("timestamp_ntz'", "TIMESTAMP '").replace(" r'", " '").replace("(r'", "('")


def suite_sql(table: str) -> str:
    parts = []
    for check in suites.suite(table):
        level = (check.severity, check.warn_above, check.error_above)
        if check.kind == "row":
            count = count_of(table, duck(check.fails))
        elif check.kind == "unique":
            where = f"{check.columns[0]} IS NOT NULL" if len(check.columns) == 1 else "TRUE"
            count = repeated(table, ", ".join(check.columns), where)
        elif check.kind == "foreign_key":
            col = check.columns[0]
            count = count_of(table, f"{col} IS NOT NULL AND {col} NOT IN (SELECT {check.parent_column} FROM {check.parent})")
        else:
            edge = f"TIMESTAMP '{DEFAULT.run_ts}' - INTERVAL {check.days} DAY"
            count = (f"CASE WHEN MAX({check.columns[0]}) >= {edge} THEN 0::BIGINT ELSE 1::BIGINT END", f"FROM {table}")
        parts.append(row(check.name, *count, *level))
    return rows(*parts)


for _table in suites.SUITES:
    if _table != "dim_date":
        o[f"suite_{_table}"] = suite_sql(_table)
