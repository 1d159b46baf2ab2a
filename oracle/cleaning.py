"""Oracle SQL of the column-rule queries."""

from __future__ import annotations

from oracle import layers as L
from oracle.ctes import AS_OF, NOW, m

ORACLE: dict[str, str] = {}


def rule(name: str, table: str, *exprs: str) -> None:
    ORACLE[name] = f"SELECT {', '.join(exprs)} FROM {table}"


TXN = ("transaction_id", "product_id")
LINE = m("quantity * unit_price * (1 - discount_percent / 100)")
REFUND = "(status = 'Refunded' OR refund_reason IS NOT NULL)"
PROMO = "(TRIM(COALESCE(promotion_code, '')) <> '')"

rule("cln1_strip_non_printable", "documents", "doc_id", f"{L.clean('text')} AS clean_text")
ORACLE["cln2_canonical_name"] = "SELECT product_id, product_name, clean_name FROM raw_products JOIN product_names USING (product_id)"
rule("cln3_full_name", "raw_customers", "customer_id", f"{L.clean('first_name')} || ' ' || {L.clean('last_name')} AS full_name")
rule("cln4_normalize_email", "raw_customers", "customer_id", f"{L.email('email')} AS email")
rule("cln4_email_in_documents", "documents", "doc_id", f"{L.email('text')} AS email")
rule("cln5_phone_country_code", "raw_customers", "customer_id", f"{L.country_code('phone')} AS country_code")
rule("cln6_phone_extension", "raw_customers", "customer_id", f"{L.extension('phone')} AS extension")
rule("cln7_phone_extract", "raw_customers", "customer_id", f"{L.subscriber('phone')} AS extracted_phone")
rule("cln7_phone_in_documents", "documents", "doc_id", f"{L.subscriber('text')} AS extracted_phone")
rule(
    "cln8_phone_ext_and_digits", "raw_customers", "customer_id",
    "CASE WHEN CONTAINS(phone, 'x') THEN REGEXP_EXTRACT(phone, 'x(\\d+)', 1) END AS phone_extension",
    "REGEXP_REPLACE(REGEXP_REPLACE(phone, 'x.*$', ''), '[^0-9]', '') AS phone_digits_only",
)
rule("cln9_store_phone", "raw_stores", "store_id", "REGEXP_REPLACE(phone, '[^0-9x+()-]', '', 'g') AS store_phone")
rule("cln10_street_from_address", "raw_customers", "customer_id", f"{L.street('address')} AS street_address")
rule("cln10_first_line_of_documents", "documents", "doc_id", f"{L.street('text')} AS street_address")
rule("cln11_full_address", "raw_stores", "store_id", f"{L.street('address')} || ', ' || city || ', ' || state || ' ' || zip_code AS full_address")
rule(
    "cln12_map_enum", "raw_customers", "customer_id", f"{L.gender('gender')} AS gender", f"{L.contact('preferred_contact')} AS preferred_contact",
    f"{L.segment('customer_segment')} AS customer_segment",
)
rule("cln13_default_bool", "raw_customers", "customer_id", "COALESCE(loyalty_member, FALSE) AS loyalty_member")
rule("cln14_safe_date", "raw_customers", "customer_id", f"{L.safe_date('date_of_birth')} AS date_of_birth")
rule("cln15_date_or_from_id", "raw_transactions", *TXN, f"{L.DAY} AS transaction_date")
rule("cln16_time_or_midnight", "raw_transactions", *TXN, "COALESCE(NULLIF(TRIM(time), ''), '00:00:00') AS transaction_time")
ORACLE["cln17_compose_datetime"] = f"""
SELECT transaction_id, product_id, CASE WHEN TRIM(date) <> '' AND TRIM(time) <> '' THEN CAST(date || ' ' || time AS TIMESTAMP)
  ELSE CAST({L.ID_DAY} AS TIMESTAMP) END AS transaction_datetime FROM raw_transactions"""
rule(
    "cln18_date_parts", "raw_transactions", *TXN, f"CAST(YEAR({L.DAY}) AS INTEGER) AS transaction_year", f"CAST(MONTH({L.DAY}) AS INTEGER) AS transaction_month",
    f"CAST(DAY({L.DAY}) AS INTEGER) AS transaction_day", f"CAST(DAYOFWEEK({L.DAY}) AS INTEGER) AS transaction_day_of_week",
    "CAST(CASE WHEN TRIM(time) <> '' THEN SPLIT_PART(time, ':', 1) END AS INTEGER) AS transaction_hour",
)
rule(
    "cln19_strip_dup_marker", "raw_transactions", "transaction_id", "REPLACE(transaction_id, 'DUP', '') AS transaction_id_clean",
    "REPLACE(transaction_id || '-' || product_id, 'DUP', '') AS transaction_product",
)
rule("cln20_upper_trim", "raw_transactions", *TXN, *[f"UPPER(TRIM({x})) AS {x}" for x in ("payment_method", "status", "promotion_code")])
rule("cln21_round_money", "lineitem", "l_orderkey", "l_linenumber", f"{m('l_extendedprice / l_quantity')} AS unit_price")
rule("cln22_negative_to_null", "raw_products", "product_id", "CASE WHEN stock_quantity < 0 THEN NULL ELSE stock_quantity END AS stock_quantity")
rule("cln23_refund_and_promotion", "raw_transactions", *TXN, f"{REFUND} AS is_refund", f"{PROMO} AS has_promotion")
rule(
    "cln24_coerce_stream_types", "live_lines", "transaction_id", "date", "time", "datetime", "customer_id", "store_id", "payment_method", "total_amount",
    "items_count", "status", "product_id", "quantity", "line_total",
)
rule("cln25_missing_time_last", "nested_headers", "transaction_id", "COALESCE(time, '23:59:59') AS time")

rule("mea1_discount_and_line_total", "raw_transactions", *TXN, "quantity * unit_price * (discount_percent / 100) AS discount_amount", f"{LINE} AS calculated_line_total")
rule("mea2_profit_margin", "raw_products", "product_id", f"{L.margin_pct('price', 'cost')} AS profit_margin_pct")
ORACLE["mea3_line_total_clean"] = f"""
SELECT transaction_id, product_id, CASE WHEN line_total < 0 AND NOT {REFUND} THEN 0.0
  WHEN line_total = 0 AND quantity > 0 AND unit_price > 0 THEN quantity * unit_price * (1 - discount_percent / 100) ELSE line_total END AS line_total_clean
FROM raw_transactions"""
rule("mea4_quantity_clean", "raw_transactions", *TXN, f"CASE WHEN {REFUND} THEN quantity ELSE ABS(quantity) END AS quantity_clean")
ORACLE["mea5_sale_amounts"] = f"""
WITH lines AS (
  SELECT *, CAST(l_quantity AS BIGINT) AS q, {m('l_extendedprice / l_quantity')} AS price, l_discount * 100 AS pct,
    CASE WHEN p_retailprice > 950 THEN p_retailprice END AS cost
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey),
totals AS (SELECT *, {m('q * price * (1 - pct / 100)')} AS total FROM lines)
SELECT l_orderkey, l_linenumber, l_partkey, {m('q * price', 4)} AS gross_amount, {m('total - q * price * (pct / 100)', 4)} AS net_amount,
  {m('q * COALESCE(cost, 0)', 4)} AS total_cost, {m('total - q * COALESCE(cost, 0)', 4)} AS line_profit,
  CASE WHEN total > 0 AND cost > 0 THEN {m('(total - q * cost) / total * 100', 4)} END AS line_profit_margin_pct
FROM totals"""
BORN, REG = L.safe_date("date_of_birth"), L.safe_date("registration_date")
OPENED, LAUNCHED = L.safe_date("opening_date"), L.safe_date("launch_date")


def since(d: str) -> str:
    return f"CASE WHEN {d} <= {AS_OF} THEN {L.days(d)} END"


rule(
    "mea6_elapsed_time", "raw_customers", "customer_id", f"CAST({L.years(BORN)} AS INTEGER) AS age", f"CAST({since(REG)} AS INTEGER) AS days_since",
    f"CAST({L.months(REG)} AS INTEGER) AS months_since", f"ROUND({since(REG)} / 365.25::DOUBLE, 0) AS years_since",
)
rule("mea7_date_key", "orders", "o_orderkey", "CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key")

rule("bkt1_age_group", "raw_customers", "customer_id", f"{L.age_group(L.years(BORN))} AS age_group")
rule("bkt2_tenure", "raw_customers", "customer_id", f"{L.tenure_months(REG)} AS tenure_by_months", f"{L.tenure_days(L.days(REG))} AS tenure_by_days")
rule("bkt3_lifetime_value", "raw_customers", "customer_id", f"{L.ltv_tier('total_lifetime_value')} AS ltv_tier", f"{L.ltv_category('total_lifetime_value')} AS ltv_category")
rule("bkt4_product_maturity", "raw_products", "product_id", f"{L.maturity_months(LAUNCHED)} AS maturity_by_months", f"{L.maturity_days('(' + since(LAUNCHED) + ')')} AS maturity_by_days")
rule("bkt5_weight_category", "raw_products", "product_id", f"{L.weight_incl('weight')} AS weight_inclusive", f"{L.weight_excl('weight')} AS weight_category")
MP = "(" + L.margin_pct("price", "cost") + ")"
rule("bkt6_margin_tier", "raw_products", "product_id", f"{L.margin_incl(MP)} AS margin_inclusive", f"{L.margin_excl(MP)} AS margin_tier")
rule(
    "bkt7_price_tier", "raw_products", "product_id", f"{L.price_tier('price')} AS price_tier",
    "CASE WHEN price > 10000 THEN 'LUXURY' WHEN price > 0 AND price < 1 THEN 'CLEARANCE' ELSE 'STANDARD' END AS price_category",
)
rule(
    "bkt8_stock_status", "raw_products", "product_id", f"{L.stock_status('stock_quantity')} AS stock_status", f"{L.holds('stock_quantity >= 1')} AS is_available",
    f"{L.holds('stock_quantity = 0')} AS is_out_of_stock", f"{L.holds('stock_quantity BETWEEN 1 AND 9')} AS is_low_stock", f"{L.holds(f'{LAUNCHED} > {AS_OF}')} AS is_upcoming",
)
rule(
    "bkt9_store_age", "raw_stores", "store_id", f"{L.store_age(OPENED)} AS store_age_category",
    f"{L.store_maturity(f'ROUND(({since(OPENED)}) / 365.25::DOUBLE, 0)')} AS store_maturity_tier", f"{L.holds(f'{L.years(OPENED)} > 20')} AS is_legacy_store",
)
rule(
    "bkt10_store_class", "raw_stores", "store_id", f"{L.store_category('UPPER(TRIM(store_type))')} AS store_category", f"{L.region('state')} AS region",
    f"{L.holds(L.clean('city') + f' IN ({L.METRO})')} AS is_metro_area",
)
rule("bkt11_fully_operational", "raw_stores", "store_id", f"{L.holds(f'{OPENED} <= {AS_OF} AND phone IS NOT NULL AND manager IS NOT NULL')} AS is_fully_operational")
rule(
    "bkt12_calendar_class", "events", "event_id", "dayofweek(ts) IN (0, 6) AS is_weekend", "dayname(ts) AS day_name", f"{L.day_part('hour(ts)')} AS time_of_day",
)
rule(
    "bkt13_sale_flags", "raw_transactions", *TXN, f"{L.holds('discount_percent > 0')} AS has_discount", f"{L.holds('quantity >= 2')} AS is_multi_quantity",
    f"{L.holds('quantity > 9')} AS is_bulk_purchase", f"{L.holds('line_total > 1000')} AS is_high_value_item", f"{L.holds('loyalty_points_earned > 0')} AS earned_loyalty_points",
)
ORACLE["bkt14_transaction_type"] = f"""
WITH flagged AS (SELECT *, {REFUND} AS is_refund, {PROMO} AS has_promotion FROM raw_transactions)
SELECT transaction_id, product_id, {L.txn_type('discount_percent')} AS transaction_type FROM flagged"""

rule("flg1_missing_flag", "raw_customers", "customer_id", L.missing("city", "state", "zip_code", "email", "phone"))
rule("flg2_range_flags", "raw_products", "product_id", L.PRODUCT_FLAGS)
rule(
    "flg3_cross_column_flags", "raw_transactions", *TXN, f"{L.fl(f'ABS({LINE} - line_total) > 100')} AS line_total_discrepancy_flag",
    f"{L.fl(f'quantity < 0 AND {L.NOT_REFUNDED}')} AS negative_quantity_flag", f"{L.fl(f'total_amount < 0 AND {L.NOT_REFUNDED}')} AS negative_amount_flag",
    f"{L.fl(f'line_total < 0 AND {L.NOT_REFUNDED}')} AS negative_line_total_flag", f"{L.fl('COALESCE(total_amount, 0) = 0')} AS zero_total_amount_flag",
    f"{L.fl('COALESCE(quantity, 0) = 0')} AS zero_quantity_flag", f"{L.fl('unit_price > 10000')} AS high_unit_price_flag",
    f"{L.fl('total_amount > 100000')} AS high_total_amount_flag",
)
rule("flg4_address_mismatch", "raw_customers", "customer_id", L.MISMATCHES)
rule("flg5_date_flags", "raw_stores", "store_id", f"{L.fl(f'{OPENED} > {AS_OF}')} AS future_opening_date_flag", f"{L.fl(f'{L.years(OPENED)} > 20')} AS very_old_store_flag")
PHONE_DIGITS = L.DIGITS.format("phone")
SUB = "(" + L.subscriber("phone") + ")"
rule(
    "flg6_phone_flags", "raw_customers", "customer_id", f"{L.fl(f'{L.blank(SUB)} OR LENGTH({L.DIGITS.format(SUB)}) < 7')} AS invalid_phone_flag",
    f"{L.fl(f'LENGTH({PHONE_DIGITS}) < 10')} AS phone_too_short_flag",
)
rule("flg7_zip_flags", "stg_customers", "customer_id", "invalid_zip_code_flag", "state_zip_mismatch_flag")
rule("flg8_quality_score", "intmd_customers", "customer_id", "quality_issues_count", "quality_tier")
ORACLE["flg9_completeness"] = """
SELECT store_id AS id, address_quality, store_data_quality AS data_quality FROM intmd_stores
UNION ALL SELECT product_id, NULL, product_data_quality FROM intmd_products"""
rule(
    "flg10_data_quality_status", "intmd_transactions", "line_item_key", "data_quality_status", "had_negative_quantity", "had_negative_amount", "had_zero_total",
    "had_missing_time", "had_missing_cashier", "had_high_unit_price",
)
rule(
    "key1_row_hash", "lineitem", "l_orderkey", "l_linenumber",
    L.row_hash("l_orderkey", "l_linenumber", "l_returnflag", L.txt("l_extendedprice"), L.txt("l_discount"), "CAST(l_shipdate AS DATE)") + " AS row_hash",
)
rule("key2_surrogate_key", "raw_transactions", *TXN, L.key("REPLACE(transaction_id, 'DUP', '')", "product_id") + " AS line_item_key")
ORACLE["key3_unknown_member"] = f"""
SELECT transaction_id, r.product_id, COALESCE(product_key, {L.key("'UNKNOWN'", 'r.product_id')}) AS product_key, MD5('-1') AS unknown_store_key
FROM raw_transactions r LEFT JOIN dim_products d ON r.product_id = d.product_id"""
rule("aud1_audit_columns", "raw_customers", "customer_id", "modified_date AS raw_loaded_at", f"{NOW} AS staging_loaded_at", L.audit("customers"))
