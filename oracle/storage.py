"""Oracle SQL of streams, sources and sinks: the batch form of what must come out."""

from __future__ import annotations

from oracle.ctes import NOW, mt
from oracle.relational import UPSERT

ORACLE: dict[str, str] = {}
o = ORACLE

TYPED = (
    "transaction_id, date, time, datetime, customer_id, store_id, payment_method, total_amount, items_count, status, product_id, quantity, line_total"
)
o["src7_message_source"] = f"SELECT {TYPED} FROM live_lines"
o["str1_source"] = "SELECT transaction_id, product_id FROM live_lines"
o["str2_typed_parse"] = "SELECT transaction_id, product_id, date, datetime, total_amount, quantity FROM live_lines"
o["str3_daily_files"] = "SELECT date, COUNT(*) AS lines, 0::BIGINT AS misfiled FROM live_lines GROUP BY date"
o["snk3_stream_to_parquet"] = "SELECT transaction_id, product_id, date, total_amount FROM live_lines"
o["str4_distinct_lines"] = "SELECT DISTINCT transaction_id, product_id, total_amount FROM live_lines WHERE transaction_id NOT LIKE 'DUP%'"
ONCE = """WITH once AS (
  SELECT DISTINCT transaction_id, datetime, total_amount, items_count, CASE WHEN store_id <> 'ST-error' THEN 'Store ' || UPPER(store_id[4:4]) || store_id[5:] END AS store_name
  FROM live_lines WHERE transaction_id NOT LIKE 'DUP%')"""
o["str5_live_store_figures"] = f"""{ONCE}
SELECT date_trunc('day', datetime) AS window_start, store_name, COUNT(*) AS transactions, {mt('SUM(total_amount)')} AS total_sales,
  {mt('AVG(total_amount)')} AS avg_basket, {mt('AVG(items_count)', 1)} AS avg_items FROM once GROUP BY 1, 2"""
o["str5_live_totals"] = f"""{ONCE}
SELECT date_trunc('day', datetime) AS window_start, COUNT(*) AS total_transactions, {mt('SUM(total_amount)')} AS total_revenue,
  COUNT(DISTINCT store_name) AS active_stores, {mt('AVG(total_amount)')} AS avg_transaction FROM once GROUP BY 1"""
o["str6_stream_static_enrich"] = """
SELECT transaction_id, store_id, CASE WHEN store_id <> 'ST-error' THEN 'Store ' || UPPER(store_id[4:4]) || store_id[5:] END AS store_name FROM live_lines"""
o["str7_closed_windows"] = f"""{ONCE}
SELECT date_trunc('hour', datetime) AS window_start, store_name, COUNT(*) AS transactions, {mt('SUM(total_amount)')} AS total_sales,
  {mt('AVG(total_amount)')} AS avg_basket, {mt('AVG(items_count)', 1)} AS avg_items FROM once
WHERE date_trunc('hour', datetime) + INTERVAL 1 HOUR <= (SELECT MAX(datetime) FROM once) - INTERVAL 1 HOUR GROUP BY 1, 2"""
o["str7_sliding_windows"] = f"""{ONCE}
SELECT date_trunc('hour', datetime) - to_hours(back) AS window_start, store_name, COUNT(*) AS transactions, {mt('SUM(total_amount)')} AS total_sales,
  {mt('AVG(total_amount)')} AS avg_basket, {mt('AVG(items_count)', 1)} AS avg_items FROM once, (VALUES (0), (1), (2)) b(back)
WHERE date_trunc('hour', datetime) - to_hours(back) + INTERVAL 3 HOUR <= (SELECT MAX(datetime) FROM once) - INTERVAL 1 HOUR GROUP BY 1, 2"""
o["str7_session_windows"] = f"""{ONCE},
marked AS (SELECT *, CASE WHEN datetime - LAG(datetime) OVER s <= INTERVAL 45 MINUTE THEN 0 ELSE 1 END AS opens FROM once WINDOW s AS (PARTITION BY store_name ORDER BY datetime)),
numbered AS (SELECT *, SUM(opens) OVER (PARTITION BY store_name ORDER BY datetime, transaction_id ROWS UNBOUNDED PRECEDING) AS session FROM marked)
SELECT MIN(datetime) AS window_start, store_name, COUNT(*) AS transactions, {mt('SUM(total_amount)')} AS total_sales,
  {mt('AVG(total_amount)')} AS avg_basket, {mt('AVG(items_count)', 1)} AS avg_items FROM numbered
GROUP BY store_name, session HAVING MAX(datetime) + INTERVAL 45 MINUTE <= (SELECT MAX(datetime) FROM once) - INTERVAL 1 HOUR"""
o["snk5_promote_stream_file"] = """
SELECT COUNT(*) AS lines, MAX(date) AS newest, FALSE AS promoted_next_day, TRUE AS promoted_same_day FROM live_lines WHERE date = (SELECT MAX(date) FROM live_lines)"""

o["src1_scan_parquet"] = "SELECT * FROM customer"
o["src2_scan_daily_files"] = "SELECT transaction_id, product_id, quantity, data_created_modified FROM raw_transactions"
o["src4_attach_file_metadata"] = "SELECT c_custkey, c_name, 'customer' AS filename FROM customer"
o["src5_attach_metadata_by_key"] = """
SELECT transaction_id, product_id, CAST(f.day + 1 AS DATE) AS _loaded_at_date FROM raw_transactions
JOIN (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) f ON regexp_extract(transaction_id, 'TXN(\\d{8})', 1) = strftime(f.day, '%Y%m%d')"""
o["src6_scan_seed_csv"] = "SELECT * FROM zip_lookup"
o["src8_flatten_items"] = """
SELECT h.* EXCLUDE (k, store_id, datetime), i.product_id, i.product_name, i.category, COALESCE(i.quantity, 0) AS quantity, COALESCE(i.unit_price, 0.0::DOUBLE) AS unit_price,
  COALESCE(i.discount_percent, 0.0::DOUBLE) AS discount_percent, COALESCE(i.line_total, 0.0::DOUBLE) AS line_total
FROM nested_headers h LEFT JOIN nested_items i USING (k)"""
o["snk1_incremental_upsert"] = UPSERT.format(
    cols="transaction_id_clean, product_id, transaction_id_raw, staging_processed_at, quantity, CAST(date_trunc('month', transaction_date) AS DATE) AS month"
)
o["snk2_overwrite_table"] = "SELECT * FROM part"
o["snk4_write_if_absent"] = "SELECT p_partkey, p_size FROM part WHERE p_size <= 25"
o["snk6_publish_snapshot"] = f"""
SELECT name, rows, {NOW} AS last_sync_time, 'success' AS status FROM (SELECT 'customer' AS name, COUNT(*) AS rows FROM customer
UNION ALL SELECT 'part', COUNT(*) FROM part UNION ALL SELECT 'supplier', COUNT(*) FROM supplier)"""
o["snk7_append_log"] = """
SELECT 1::BIGINT AS log_id, 'customer' AS table_name, COUNT(*) AS row_count FROM customer
UNION ALL SELECT 2, 'part', COUNT(*) FROM part UNION ALL SELECT 3, 'orders', COUNT(*) FROM orders"""
o["drf1_rebuild_on_drift"] = f"""
SELECT 1::BIGINT AS log_id, 'stg_customers' AS model_name, {NOW} AS detected_at, 'full_refresh' AS reconciliation_method, 'completed' AS reconciliation_status,
  'batch-20011231' AS run_id, {NOW} AS created_at, COUNT(*) AS rows, TRUE AS first_run, FALSE AS second_run FROM customer"""
o["drf1_drift_by_kind"] = """
SELECT k.model_name, COUNT(*) AS rows, CAST(SUM(c_custkey) AS BIGINT) AS keys, CASE WHEN k.model_name = 'added' THEN 0 ELSE COUNT(c_mktsegment) END AS segments,
  COUNT(c_acctbal) AS balances, k.log_id, k.reconciliation_method
FROM customer, (VALUES ('added', 1::BIGINT, 'schema_version'), ('widened', 2, 'schema_version'), ('incompatible', 3, 'full_refresh'), ('removed', 4, 'full_refresh'),
  ('same', NULL, NULL)) k(model_name, log_id, reconciliation_method) GROUP BY k.model_name, k.log_id, k.reconciliation_method"""
