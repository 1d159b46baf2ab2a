"""Oracle SQL of filters, joins, aggregates, windows, marts and incremental queries."""

from __future__ import annotations

from oracle import layers as L
from oracle.ctes import NOW, m, mt
from oracle.marts import CENTS, DIMS, FIRST, version

ORACLE: dict[str, str] = {}
o = ORACLE
CUT = "TIMESTAMP '1999-01-01'"

o["fil1_customer_admission"] = """
SELECT customer_id, email, city, state, zip_code FROM stg_customers
WHERE missing_email_flag = 0 AND missing_city_flag = 0 AND missing_state_flag = 0 AND missing_zip_code_flag = 0 AND missing_phone_flag + negative_ltv_flag < 3"""
o["fil2_product_admission"] = """
SELECT product_id, product_name_raw, category FROM stg_products
WHERE product_id IS NOT NULL AND 0 = ALL (SELECT UNNEST([missing_product_name_flag, invalid_price_flag, invalid_cost_flag, cost_exceeds_price_flag, missing_category_flag]))"""
o["fil3_store_admission"] = """
SELECT store_id, store_phone, opening_date FROM stg_stores
WHERE store_id IS NOT NULL AND GREATEST(missing_store_name_flag, missing_city_flag, missing_state_flag, missing_zip_code_flag, missing_phone_flag,
  phone_too_short_flag, missing_opening_date_flag, future_opening_date_flag) = 0"""
o["fil4_transaction_admission"] = "SELECT transaction_id_clean, product_id, total_amount, is_refund FROM admitted_lines"
o["fil5_predicates"] = """
SELECT p_partkey, p_name, p_brand FROM part WHERE regexp_matches(p_name, '^(small|red|blue) ') AND p_type LIKE '%M%'
  AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4') AND p_retailprice BETWEEN 900 AND 980 AND p_size IS NOT NULL"""
o["fil6_null_safe_change"] = f"""
SELECT n.customer_id, n.customer_tenure_category FROM intmd_customers n JOIN first_customers o USING (customer_id)
WHERE {' OR '.join(f'n.{a} IS DISTINCT FROM o.{a}' for a in DIMS['customers'][3].split(', '))}"""
o["fil7_high_water_mark"] = f"""
SELECT transaction_id_raw, product_id, raw_loaded_at, staging_processed_at FROM stg_transactions
WHERE raw_loaded_at > (SELECT MAX(LEAST(l_shipdate, {CUT})) FROM lineitem WHERE l_returnflag = 'N')"""
o["fil8_drop_marked_duplicates"] = "SELECT transaction_id, product_id, quantity FROM raw_transactions WHERE transaction_id NOT LIKE '%DUP%'"

o["joi1_inner_equi"] = f"""
SELECT customer_id, a.email, b.extracted_phone FROM raw_customers a JOIN (SELECT customer_id, {L.subscriber('phone')} AS extracted_phone FROM raw_customers) b USING (customer_id)"""
o["joi2_left_lookup"] = """
SELECT customer_id, zip_code, state_abrv AS state_code_from_zip, state_name AS state_name_from_zip, county_name, fips_code, cent_lat AS latitude, cent_long AS longitude
FROM raw_customers LEFT JOIN zip_lookup USING (zip_code)"""
o["joi3_star_lookup"] = "SELECT line_item_key, customer_id, product_id, store_id, customer_key, product_key, cost_price, store_key FROM looked_up"
o["joi4_one_row_cross_join"] = "SELECT c_custkey, c_name, (SELECT MAX(o_orderdate) FROM orders) AS newest_order, (SELECT COUNT(*) FROM orders) AS orders FROM customer"
o["joi5_semi_membership"] = """
SELECT customer_id, state, zip_code FROM raw_customers WHERE (state, zip_code) IN (SELECT (state_name, zip_code) FROM zip_lookup)"""
o["joi6_anti_not_exists"] = """
SELECT customer_id, _row_hash FROM stg_customers s WHERE NOT EXISTS (SELECT 1 FROM stg_customers h
  WHERE h.registration_date < DATE '1999-01-01' AND h.customer_id = s.customer_id AND h._row_hash = s._row_hash)"""
o["joi7_anti_calendar_gaps"] = """
WITH span AS (SELECT MIN(o_orderdate) AS a, MAX(o_orderdate) AS b FROM orders)
SELECT CAST(d AS DATE) AS expected_date FROM span, LATERAL (SELECT UNNEST(generate_series(a, b, INTERVAL 1 DAY)) AS d)
WHERE CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)"""
o["joi8_new_or_changed"] = "SELECT product_id, supplier FROM changed_products"
o["joi9_rows_to_close"] = f"""
SELECT product_id, {L.key('product_id', NOW)} AS product_key, {NOW} AS valid_end_date, FALSE AS is_current
FROM loaded_products WHERE product_id IN (SELECT product_id FROM changed_products)"""
o["joi10_store_enrichment"] = """
SELECT transaction_id, product_id, l.store_id, CASE l.store_id WHEN 'ST-view' THEN 'Store View' WHEN 'ST-click' THEN 'Store Click'
  WHEN 'ST-purchase' THEN 'Store Purchase' WHEN 'ST-signup' THEN 'Store Signup' END AS store_name FROM live_lines l"""

o["agg1_staging_profile"] = "SELECT * FROM staging_profile"
o["agg2_staging_grades"] = """
SELECT profile_date, line_item_grain_health, transaction_size_health, health_status, quality_tier, quality_alert_flag, actual_line_items_per_txn_ratio,
  duplicate_line_item_pct, profile_created_at, source_system, grain_level FROM staging_grades"""
o["agg3_intermediate_profile"] = "SELECT * FROM lines_profile"
o["agg4_intermediate_grades"] = """
SELECT profile_date, deduplication_status, transaction_size_health, health_status, quality_tier, refund_health, promotion_intensity, quality_alert_flag,
  deduplication_success_pct, profile_created_at, entity_type, grain_level FROM lines_grades"""
o["agg5_conditional_counts"] = """
SELECT l_linestatus, COUNT(*) FILTER (l_returnflag = 'R') AS returned, COUNT(*) FILTER (l_discount > 0) AS discounted, COUNT(*) AS lines
FROM lineitem GROUP BY l_linestatus"""
o["agg6_count_distinct"] = """
SELECT store_id, COUNT(DISTINCT transaction_id) AS transactions, COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT CONCAT(transaction_id, '|', product_id)) AS pairs
FROM raw_transactions GROUP BY store_id"""
o["agg7_safe_ratio"] = f"""
SELECT l_suppkey, {mt("COUNT(*) FILTER (l_returnflag = 'R' AND l_discount > 0.05::DOUBLE) * 100.0::DOUBLE / NULLIF(COUNT(*) FILTER (l_returnflag = 'R'), 0)")} AS deep_pct,
  {mt("GREATEST(0.0::DOUBLE, 100.0::DOUBLE - COUNT(*) FILTER (l_returnflag = 'R') * 100.0::DOUBLE / NULLIF(COUNT(*), 0) * 3.0::DOUBLE)")} AS score
FROM lineitem GROUP BY l_suppkey"""
o["agg8_dimension_counts"] = "SELECT * FROM dim_rows"
o["agg9_fact_statistics"] = "SELECT * FROM fact_stats"
o["agg10_orphan_counts"] = "SELECT * FROM orphans"
o["agg11_gold_metrics"] = f"""
SELECT {NOW} AS run_date, 'batch-20011231' AS run_id, CAST(dim_customers_count AS BIGINT) AS dim_customers_count, CAST(dim_products_count AS BIGINT) AS dim_products_count,
  CAST(dim_stores_count AS BIGINT) AS dim_stores_count, CAST(dim_date_count AS BIGINT) AS dim_date_count, CAST(n AS BIGINT) AS total_sales_records,
  CAST(r AS DECIMAL(30,2)) AS total_revenue, CAST(p AS DECIMAL(30,2)) AS total_profit, TRY_CAST(mg AS DECIMAL(18,2)) AS profit_margin_pct,
  CAST(quality_score AS DECIMAL(5,2)) AS quality_score, CAST(orphan_customers AS BIGINT) AS orphan_customers, CAST(orphan_products AS BIGINT) AS orphan_products,
  CAST(orphan_stores AS BIGINT) AS orphan_stores, {NOW} AS created_at
FROM gold, (SELECT COUNT(*) AS n, SUM(line_total) AS r, SUM(line_profit) AS p, AVG(line_profit_margin_pct) AS mg FROM fact_sales WHERE NOT is_refund)"""
o["agg12_daily_revenue"] = f"SELECT transaction_date, {mt('SUM(line_total_clean)')} AS revenue FROM intmd_transactions GROUP BY transaction_date"
o["agg13_store_month_revenue"] = f"""
SELECT store_name, transaction_month, {mt('SUM(line_total_clean)')} AS revenue FROM intmd_transactions GROUP BY store_name, transaction_month"""
o["agg14_top_categories"] = f"""
SELECT category, {mt('SUM(line_total_clean)')} AS revenue FROM intmd_transactions WHERE NOT is_refund GROUP BY category ORDER BY revenue DESC, category LIMIT 10"""
o["agg15_having_duplicates"] = """
SELECT REPLACE(transaction_id, 'DUP', '') AS transaction_id_clean, product_id, COUNT(*) AS duplicate_count FROM raw_transactions GROUP BY 1, 2 HAVING COUNT(*) > 1"""
o["agg16_payment_share"] = f"""
SELECT o_orderpriority AS payment_method, {mt('COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER ()', 4)} AS percentage FROM orders GROUP BY o_orderpriority"""
o["agg17_transaction_rollup"] = f"""
SELECT h.* EXCLUDE (k, cashier_id), {mt('COALESCE(lt, 0)')} AS line_total, COALESCE(q, 0) AS quantity FROM nested_headers h
LEFT JOIN (SELECT k, SUM(line_total) AS lt, CAST(SUM(quantity) AS BIGINT) AS q FROM nested_items GROUP BY k) USING (k)"""
LIVE = """WITH once AS (
  SELECT DISTINCT ON (transaction_id, product_id) * FROM live_lines WHERE transaction_id NOT LIKE '%DUP%' ORDER BY transaction_id, product_id),
named AS (SELECT *, CASE WHEN store_id <> 'ST-error' THEN 'Store ' || UPPER(store_id[4:4]) || store_id[5:] END AS store_name FROM once)"""
o["agg18_live_totals"] = f"""{LIVE}
SELECT COUNT(*) AS total_transactions, {mt('SUM(total_amount)')} AS total_revenue, COUNT(DISTINCT store_name) AS active_stores, {mt('AVG(total_amount)')} AS avg_transaction
FROM named"""
o["agg18_live_store_metrics"] = f"""{LIVE}
SELECT store_name, {mt('SUM(total_amount)')} AS total_sales, COUNT(*) AS transactions, {mt('AVG(total_amount)')} AS avg_basket, {mt('AVG(items_count)', 1)} AS avg_items
FROM named GROUP BY store_name"""
o["agg19_payment_breakdown"] = "SELECT COALESCE(payment_method, 'Unknown') AS payment_method, COUNT(*) AS transactions FROM nested_headers GROUP BY 1"
o["agg20_category_breakdown"] = f"""
SELECT COALESCE(category, 'Unknown') AS category, CAST(SUM(ABS(quantity)) AS BIGINT) AS count, {mt('SUM(line_total)')} AS revenue FROM nested_items GROUP BY 1"""
o["agg21_top_products"] = f"""
SELECT product_id, MIN(product_name) AS product_name, CAST(SUM(ABS(quantity)) AS BIGINT) AS quantity_sold, {mt('SUM(line_total)')} AS revenue
FROM nested_items GROUP BY product_id ORDER BY revenue DESC, product_id LIMIT 10"""
o["agg22_daily_summary"] = f"""
SELECT h.date, COUNT(*) AS total_transactions, {mt('SUM(total_amount)')} AS total_revenue, CAST(SUM(items_count) AS BIGINT) AS total_items_sold,
  COUNT(DISTINCT customer_id) AS unique_customers, COUNT(*) FILTER (transaction_id LIKE '%DUP%') AS duplicate_transactions,
  COUNT(*) FILTER (status = 'Failed') AS failed_transactions, COUNT(*) FILTER (status = 'Refunded') AS refunded_transactions,
  COUNT(*) - COUNT(datetime) AS missing_timestamps, COUNT(*) - COUNT(cashier_id) AS missing_cashier_ids,
  CAST(COALESCE(SUM(neg), 0) AS BIGINT) AS negative_quantities
FROM nested_headers h LEFT JOIN (SELECT k, COUNT(*) AS neg FROM nested_items WHERE quantity < 0 GROUP BY k) USING (k) GROUP BY h.date"""

o["win1_dedup_latest_line"] = "SELECT transaction_id_clean, product_id, transaction_id_raw, staging_processed_at, quantity FROM latest_lines"
o["win2_first_line"] = """
SELECT transaction_id_clean, product_id, total_amount FROM stg_transactions
QUALIFY ROW_NUMBER() OVER (PARTITION BY transaction_id_clean ORDER BY product_id NULLS LAST, transaction_id_raw, total_amount) = 1"""
o["win3_occurrences"] = """
SELECT REPLACE(transaction_id, 'DUP', '') AS transaction_id_clean, product_id, transaction_id,
  COUNT(*) OVER (PARTITION BY REPLACE(transaction_id, 'DUP', ''), product_id) AS occurrences FROM raw_transactions"""
o["win4_share_of_total"] = f"""
SELECT l_suppkey, COUNT(*) AS n, {mt('COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER ()', 4)} AS pct FROM lineitem GROUP BY l_suppkey"""
DAYS = f"""WITH daily AS (SELECT CAST(o_orderdate AS DATE) AS date, {CENTS.format('o_totalprice')} / 100.0::DOUBLE AS revenue FROM orders GROUP BY 1),
days AS (SELECT CAST(d AS DATE) AS date, COALESCE(revenue, 0) AS revenue FROM (SELECT UNNEST(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS d FROM daily)
  LEFT JOIN daily x ON x.date = CAST(d AS DATE))"""
o["win5_day_change"] = f"""{DAYS}
SELECT date, {mt('revenue - LAG(revenue) OVER (ORDER BY date)')} AS change_1, {mt('revenue - LAG(revenue, 7) OVER (ORDER BY date)')} AS change_7 FROM days"""
o["win6_rolling_mean"] = f"""{DAYS}
SELECT date, {mt('AVG(revenue) OVER (ORDER BY date ROWS 6 PRECEDING)')} AS mean_7, {mt('AVG(revenue) OVER (ORDER BY date ROWS 29 PRECEDING)')} AS mean_30 FROM days"""
o["win7_to_date_totals"] = f"""{DAYS}
SELECT date, {mt("SUM(revenue) OVER (PARTITION BY date_trunc('month', date) ORDER BY date)")} AS mtd, {mt('SUM(revenue) OVER (PARTITION BY year(date) ORDER BY date)')} AS ytd FROM days"""
PARTS = f"""WITH parts AS (SELECT l_partkey, p_type, {CENTS.format('l_extendedprice')} AS revenue_cents, CAST(SUM(l_quantity) AS BIGINT) AS units
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""
o["win8_global_ranks"] = f"""{PARTS}
SELECT *, RANK() OVER (ORDER BY revenue_cents DESC) AS revenue_rank, RANK() OVER (ORDER BY units DESC) AS units_rank,
  RANK() OVER (PARTITION BY p_type ORDER BY revenue_cents DESC) AS rank_in_type FROM parts"""
o["win8_global_ranks_in_ranges"] = o["win8_global_ranks"]
o["win9_percentile_tiers"] = f"""{PARTS},
ranked AS (SELECT l_partkey, RANK() OVER (ORDER BY revenue_cents DESC) AS rk, PERCENT_RANK() OVER (ORDER BY revenue_cents DESC) AS pr FROM parts)
SELECT l_partkey, {mt('pr', 4)} AS percent_rank, CASE WHEN rk <= 10 THEN 'Top 10' WHEN pr <= 0.2 THEN 'Top 20%' WHEN pr <= 0.5 THEN 'Top 50%' ELSE 'Bottom 50%' END AS performance_tier
FROM ranked"""
o["win10_abc_class"] = f"""{PARTS},
shares AS (SELECT l_partkey, CAST(SUM(revenue_cents) OVER (ORDER BY revenue_cents DESC) AS DOUBLE) / CAST(SUM(revenue_cents) OVER () AS DOUBLE) AS sh FROM parts)
SELECT l_partkey, {mt('sh', 6)} AS share, CASE WHEN sh <= 0.8 THEN 'A - Top Products' WHEN sh <= 0.95 THEN 'B - Medium Products' ELSE 'C - Low Products' END AS abc_class
FROM shares"""

o["srt1_order_by"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey"
o["srt2_top_k"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25"
o["set1_union_all"] = """
SELECT 'customer' AS kind, c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT 'supplier', s_name, s_acctbal FROM supplier"""
o["set2_distinct"] = f"SELECT DISTINCT {L.clean('p_name')} AS name, p_brand FROM part"
o["gen1_date_spine"] = """
SELECT CAST(d AS DATE) AS date_day, COUNT(event_id) AS events FROM (SELECT UNNEST(generate_series(DATE '2020-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS d)
LEFT JOIN events ON CAST(ts AS DATE) = CAST(d AS DATE) GROUP BY 1"""
o["gen2_date_series"] = """
SELECT CAST(DATE '1995-01-01' + CAST(n AS INTEGER) AS DATE) AS expected_date, COUNT(o_orderkey) AS orders FROM (SELECT UNNEST(generate_series(0, 2499)) AS n)
LEFT JOIN orders ON CAST(o_orderdate AS DATE) = DATE '1995-01-01' + CAST(n AS INTEGER) GROUP BY 1"""

o["dim1_calendar"] = "SELECT * FROM calendar"
for _i, _n in enumerate(("customers", "products", "stores"), 2):
    o[f"dim{_i}_{_n}"] = f"SELECT * FROM dim_{_n}"
    o[f"scd2_{_n}_two_batches"] = f"SELECT * FROM merged_{_n}"
o["scd2_stored_in_parts"] = "SELECT * FROM merged_customers"
AMOUNTS = ["net_amount", "gross_amount", "total_cost", "line_profit", "line_profit_margin_pct", "line_total", "discount_amount"]
o["fct1_fact_sales"] = f"SELECT * REPLACE ({', '.join(f'{m(a, 4)} AS {a}' for a in AMOUNTS)}) FROM fact_sales"
o["mrt1_revenue_performance"] = "SELECT * FROM revenue_performance"
o["mrt2_store_performance"] = "SELECT * FROM store_performance"
o["mrt3_products_performance"] = "SELECT * FROM products_performance"
o["mrt4_customer_metrics"] = "SELECT * FROM customer_metrics"
o["mrt5_revenue_consistency"] = f"""
SELECT d AS daily_revenue, s AS store_revenue, d = s AS consistent
FROM (SELECT {mt('SUM(revenue)')} AS d FROM revenue_performance), (SELECT {mt('SUM(total_revenue)')} AS s FROM store_performance)"""

o["gat1_staging_gate"] = """
SELECT profile_date, total_line_items, unique_txn_product_combinations, avg_line_items_per_transaction, line_item_quality_score, duplicate_line_item_pct,
  health_status, quality_tier, line_item_quality_score >= 70 AS passed FROM staging_grades ORDER BY profile_date DESC LIMIT 1"""
o["gat2_intermediate_gate"] = """
WITH judged AS (SELECT *, deduplication_success_pct = 100 AS dedup_perfect, transaction_intermediate_quality_score >= 90 AS quality_ok, clean_pct >= 70 AS clean_ok,
  refund_pct <= 10 AS refund_ok, avg_items_per_transaction >= 1.5 AND avg_items_per_transaction <= 3 AS avg_items_ok, total_line_items = unique_line_items AS unique_ok
  FROM lines_grades ORDER BY profile_date DESC LIMIT 1)
SELECT profile_date, total_line_items, unique_line_items, unique_transactions, avg_items_per_transaction, clean_pct, corrected_pct, refund_pct,
  deduplication_success_pct, transaction_intermediate_quality_score, health_status, quality_tier, dedup_perfect, quality_ok, clean_ok, refund_ok, avg_items_ok,
  unique_ok, dedup_perfect AND quality_ok AND clean_ok AND refund_ok AND avg_items_ok AND unique_ok AS passed FROM judged"""
o["gat3_gold_gate"] = "SELECT * FROM gold"

_H = L.row_hash("product_id", "supplier", "category")
o["inc1_hash_capture"] = f"""
SELECT DISTINCT product_id, {_H} AS _row_hash, supplier FROM intmd_products
WHERE (product_id, {_H}) NOT IN (SELECT (product_id, {_H}) FROM first_products)"""
o["inc2_watermark_capture"] = f"""
SELECT transaction_id_raw, product_id, raw_loaded_at, staging_processed_at FROM stg_transactions
WHERE raw_loaded_at > (SELECT MAX(staging_processed_at) FROM stg_transactions WHERE staging_processed_at < {CUT})"""
UPSERT = f"""WITH batch AS (SELECT * FROM stg_transactions WHERE staging_processed_at >= {CUT})
SELECT {{cols}} FROM stg_transactions t WHERE staging_processed_at < {CUT} AND NOT EXISTS (SELECT 1 FROM batch b
  WHERE b.transaction_id_clean = t.transaction_id_clean AND b.product_id IS NOT DISTINCT FROM t.product_id)
UNION ALL SELECT {{cols}} FROM batch"""
o["inc3_upsert_by_key"] = UPSERT.format(cols="transaction_id_clean, product_id, transaction_id_raw, staging_processed_at, quantity")
o["inc4_profile_upsert"] = f"""
SELECT profile_date, total_line_items, CASE WHEN profile_date < {CUT} THEN 0 ELSE unique_transactions END AS unique_transactions FROM staging_profile"""
o["scd1_initial_load"] = version("once_stores", "store_id", "store_key", DIMS["stores"][2], FIRST)
o["scd3_current_view"] = "SELECT product_id, product_key, supplier, valid_start_date FROM merged_products WHERE is_current"
