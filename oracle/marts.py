"""Oracle CTEs of dimensions, fact, profiles and marts."""

from __future__ import annotations

from oracle.ctes import AS_OF, CTES, NOW, mt
from oracle.layers import key, tenure_days
from tillhouse.plans.marts import DIMENSIONS

FIRST = "TIMESTAMP '1998-12-31 06:00:00'"
FIRST_DAY = "DATE '1998-12-31'"
DIMS = {
    name: (id_, key_, ", ".join(attributes), ", ".join(tracked)) for name, (id_, key_, attributes, tracked) in DIMENSIONS.items()
}


def version(source: str, id_: str, key_: str, attrs: str, at: str, end: str = "CAST(NULL AS TIMESTAMP)", cur: str = "TRUE") -> str:
    return (
        f"SELECT {key(id_, at)} AS {key_}, {id_}, {attrs}, {at} AS valid_start_date, {end} AS valid_end_date, {cur} AS is_current, "
        f"{at} AS created_at, {at} AS updated_at FROM {source}"
    )


CTES["first_customers"] = f"""
SELECT DISTINCT * REPLACE (CAST(days_since_registration - 1096 AS INTEGER) AS days_since_registration,
  {tenure_days('(days_since_registration - 1096)')} AS customer_tenure_category)
FROM intmd_customers WHERE registration_date <= {FIRST_DAY}"""
CTES["first_products"] = f"""
SELECT DISTINCT * REPLACE (CASE WHEN days_since_launch - 1096 < 180 THEN 'Launch vendor' ELSE supplier END AS supplier)
FROM intmd_products WHERE launch_date <= {FIRST_DAY}"""
CTES["first_stores"] = f"""
SELECT DISTINCT * REPLACE (CASE WHEN days_since_opening - 1096 < 1825 THEN 'Acting manager' ELSE manager END AS manager)
FROM intmd_stores WHERE opening_date <= {FIRST_DAY}"""

for _name, (_id, _key, _attrs, _tracked) in DIMS.items():
    CTES[f"once_{_name}"] = f"SELECT DISTINCT {_id}, {_attrs} FROM intmd_{_name}"
    CTES[f"dim_{_name}"] = version(f"once_{_name}", _id, _key, _attrs, NOW)
    CTES[f"loaded_{_name}"] = version(f"first_{_name}", _id, _key, _attrs, FIRST)
    _same = " AND ".join(f"n.{a} IS NOT DISTINCT FROM o.{a}" for a in _tracked.split(", "))
    CTES[f"changed_{_name}"] = f"""
SELECT n.* FROM once_{_name} n LEFT JOIN loaded_{_name} o ON n.{_id} = o.{_id} WHERE o.{_id} IS NULL OR NOT ({_same})"""
    CTES[f"merged_{_name}"] = f"""
SELECT o.* REPLACE (CASE WHEN c.{_id} IS NOT NULL THEN {NOW} END AS valid_end_date, c.{_id} IS NULL AS is_current,
  CASE WHEN c.{_id} IS NOT NULL THEN {NOW} ELSE o.updated_at END AS updated_at)
FROM loaded_{_name} o LEFT JOIN changed_{_name} c ON o.{_id} = c.{_id}
UNION ALL BY NAME {version(f'changed_{_name}', _id, _key, _attrs, NOW)}"""

CTES["looked_up"] = """
SELECT t.*, c.customer_key, p.product_key, p.cost_price, s.store_key
FROM intmd_transactions t LEFT JOIN dim_customers c ON t.customer_id = c.customer_id
LEFT JOIN dim_products p ON t.product_id = p.product_id LEFT JOIN dim_stores s ON t.store_id = s.store_id
"""
CTES["fact_sales"] = f"""
SELECT line_item_key AS sales_key, CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS date_key,
  COALESCE(customer_key, MD5('-1')) AS customer_key, COALESCE(product_key, {key("'UNKNOWN'", 'product_id')}) AS product_key,
  COALESCE(store_key, MD5('-1')) AS store_key, transaction_id, cashier_id, promotion_code, refund_reason, store_name, transaction_date,
  transaction_time, transaction_datetime, transaction_year, transaction_month, transaction_day, transaction_hour, payment_method, payment_status,
  transaction_type, is_refund, has_promotion, has_discount, is_weekend, is_multi_quantity, is_bulk_purchase, is_high_value_item,
  earned_loyalty_points, day_name, time_of_day, product_name, category, quantity_clean AS quantity, items_count, unit_price, discount_percent,
  line_total_clean AS line_total, discount_amount, subtotal, tax_amount, total_amount, quantity_clean * unit_price AS gross_amount,
  line_total_clean - discount_amount AS net_amount, quantity_clean * COALESCE(cost_price, 0) AS total_cost,
  line_total_clean - quantity_clean * COALESCE(cost_price, 0) AS line_profit,
  CASE WHEN line_total_clean > 0 AND cost_price > 0 THEN (line_total_clean - quantity_clean * cost_price) / line_total_clean * 100 END AS line_profit_margin_pct,
  loyalty_points_earned, data_quality_status, had_negative_quantity, had_negative_amount, had_zero_total, had_missing_time, had_missing_cashier,
  had_high_unit_price, raw_loaded_at AS date_of_creation, staging_processed_at, intermediate_processed_at AS fact_loaded_at, _source_system, {NOW} AS created_at
FROM looked_up
"""

CTES["calendar_days"] = """
SELECT CAST(UNNEST(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d
FROM (SELECT date_trunc('year', MIN(o_orderdate)) AS a, CAST(MAX(o_orderdate) AS DATE) + INTERVAL 400 DAY AS b FROM orders)
"""
HOLIDAY = """CASE WHEN strftime(d, '%m-%d') = '01-01' THEN 'New Year''s Day' WHEN strftime(d, '%m-%d') = '07-04' THEN 'Independence Day'
  WHEN strftime(d, '%m-%d') = '12-25' THEN 'Christmas Day'
  WHEN month(d) = 11 AND dayname(d) = 'Thursday' AND (day(d) - 1) // 7 = 3 THEN 'Thanksgiving' END"""


def within(unit: str) -> str:
    return f"date_trunc('{unit}', d) = date_trunc('{unit}', {AS_OF})"


def i(expr: str) -> str:
    return f"CAST({expr} AS INTEGER)"


CTES["calendar"] = f"""
SELECT {i("strftime(d, '%Y%m%d')")} AS date_key, d AS date_actual, {i('year(d)')} AS year, 'Y' || year(d) AS year_name, {i('quarter(d)')} AS quarter,
  'Q' || quarter(d) AS quarter_name, 'Y' || year(d) || '-Q' || quarter(d) AS year_quarter, {i('month(d)')} AS month, strftime(d, '%B') AS month_name,
  strftime(d, '%b') AS month_name_short, strftime(d, 'Y%Y-M%m') AS year_month, {i('weekofyear(d)')} AS week_of_year,
  'W' || LPAD(CAST(weekofyear(d) AS VARCHAR), 2, '0') AS week_name, 'Y' || year(d) || '-W' || LPAD(CAST(weekofyear(d) AS VARCHAR), 2, '0') AS year_week,
  {i('day(d)')} AS day_of_month, {i('dayofyear(d)')} AS day_of_year, {i('dayofweek(d)')} AS day_of_week, strftime(d, '%A') AS day_name,
  strftime(d, '%a') AS day_name_short, isodow(d) > 5 AS is_weekend, isodow(d) < 6 AS is_weekday, {HOLIDAY} AS holiday_name, ({HOLIDAY}) IS NOT NULL AS is_holiday,
  {i('year(d)')} AS fiscal_year, {i('quarter(d)')} AS fiscal_quarter, {i('month(d)')} AS fiscal_month, d = {AS_OF} AS is_today,
  d = {AS_OF} - 1 AS is_yesterday, d = {AS_OF} + 1 AS is_tomorrow, {within('week')} AS is_current_week, {within('month')} AS is_current_month,
  {within('quarter')} AS is_current_quarter, {within('year')} AS is_current_year,
  {', '.join(f"d BETWEEN {AS_OF} - {n} AND {AS_OF} AS is_last_{n}_days" for n in (7, 30, 90, 365))},
  day(d) = 1 AS is_first_day_of_month, day(d + 1) = 1 AS is_last_day_of_month, {NOW} AS created_at
FROM calendar_days
"""


def pct(part: str, whole: str = "total_line_items") -> str:
    return f"(CAST({part} AS DOUBLE) * 100.0 / CAST({whole} AS DOUBLE))"


def s(flag: str) -> str:
    return f"CAST(SUM({flag}) AS BIGINT)"


def n_if(test: str) -> str:
    return f"COUNT(*) FILTER ({test})"


CTES["staging_marked"] = """
SELECT *, date_trunc('day', staging_processed_at) AS profile_date, COUNT(*) OVER (PARTITION BY transaction_id_clean, product_id) AS occurrences,
  ROW_NUMBER() OVER (PARTITION BY transaction_id_clean ORDER BY product_id NULLS LAST, transaction_id_raw, total_amount, staging_processed_at) AS line_no
FROM stg_transactions
"""
CTES["staging_daily"] = f"""
SELECT profile_date, MIN(transaction_date) AS min_transaction_date, MAX(transaction_date) AS max_transaction_date, COUNT(*) AS total_line_items,
  COUNT(DISTINCT transaction_id_clean || '|' || COALESCE(product_id, '')) AS unique_txn_product_combinations,
  COUNT(DISTINCT transaction_id_clean) AS unique_transactions, COUNT(DISTINCT customer_id) AS unique_customers,
  COUNT(DISTINCT product_id) AS unique_products_sold, COUNT(DISTINCT store_id) AS unique_stores,
  {n_if('occurrences > 1')} AS duplicate_txn_product_line_items, {s('missing_transaction_id_flag')} AS missing_transaction_id_clean_count,
  {s('missing_date_flag')} AS missing_date_count, {s('missing_customer_id_flag')} AS missing_customer_id_count,
  {s('missing_product_id_flag')} AS missing_product_id_count, {s('negative_quantity_flag')} AS negative_quantity_count,
  {s('negative_amount_flag')} AS negative_amount_count, {s('zero_total_amount_flag')} AS zero_total_count, {s('zero_quantity_flag')} AS zero_quantity_count,
  {s('high_unit_price_flag')} AS high_unit_price_count, {mt('SUM(line_total)', 4)} AS total_line_item_revenue, {mt('AVG(line_total)', 4)} AS avg_line_item_value,
  {s('quantity')} AS total_quantity_sold, {mt('AVG(quantity)', 4)} AS avg_quantity_per_line,
  {mt('SUM(CASE WHEN line_no = 1 THEN total_amount ELSE 0 END)', 4)} AS total_transaction_revenue,
  {n_if('is_refund')} AS refund_line_items, {n_if('has_promotion')} AS promotion_line_items, {n_if('quantity < 0')} AS negative_quantity_lines
FROM staging_marked GROUP BY profile_date
"""
CTES["staging_profile"] = f"""
SELECT *, {mt(pct('total_line_items', 'unique_transactions') + ' / 100.0')} AS avg_line_items_per_transaction,
  {mt(pct('missing_transaction_id_clean_count'))} AS missing_txn_id_pct, {mt(pct('missing_date_count'))} AS missing_date_pct,
  {mt(pct('missing_customer_id_count'))} AS missing_customer_pct, {mt(pct('missing_product_id_count'))} AS missing_product_pct,
  {mt(pct('negative_quantity_count'))} AS negative_quantity_pct, {mt(pct('zero_total_count'))} AS zero_total_pct,
  {mt(f"GREATEST(0.0::DOUBLE, 100.0::DOUBLE - {pct('missing_transaction_id_clean_count')} - {pct('missing_date_count')} - {pct('missing_product_id_count')} - {pct('negative_quantity_count')} * 0.5 - {pct('zero_total_count')} * 0.5)", 4)} AS line_item_quality_score
FROM staging_daily
"""


def baskets(x: str) -> str:
    return f"""CASE WHEN {x} < 1.5 THEN 'Low - Few Multi-Item Transactions' WHEN {x} > 3 THEN 'High - Many Multi-Item Transactions'
      ELSE 'Healthy - Normal Distribution' END"""


CTES["staging_grades"] = f"""
SELECT *, CASE WHEN duplicate_txn_product_line_items = 0 OR total_line_items = unique_txn_product_combinations THEN 'Clean - No Duplicates'
    WHEN duplicate_txn_product_line_items >= total_line_items * 0.05::DOUBLE THEN 'Poor - 5%+ Duplicates'
    WHEN duplicate_txn_product_line_items >= total_line_items * 0.01::DOUBLE THEN 'Fair - <5% Duplicates' ELSE 'Good - <1% Duplicates' END AS line_item_grain_health,
  {baskets('avg_line_items_per_transaction')} AS transaction_size_health,
  CASE WHEN line_item_quality_score < 70 THEN 'Critical' WHEN line_item_quality_score < 80 THEN 'Poor' WHEN line_item_quality_score < 90 THEN 'Fair'
    WHEN line_item_quality_score < 95 THEN 'Good' ELSE 'Excellent' END AS health_status,
  CASE WHEN GREATEST(missing_txn_id_pct, missing_date_pct, missing_product_pct) >= 5 OR negative_quantity_pct >= 5 THEN 'POOR'
    WHEN missing_txn_id_pct + missing_date_pct + missing_product_pct > 0 OR negative_quantity_pct >= 1 THEN 'ACCEPTABLE' ELSE 'CLEAN' END AS quality_tier,
  line_item_quality_score < 70 OR GREATEST(missing_txn_id_pct, missing_date_pct, missing_product_pct) > 10
    OR duplicate_txn_product_line_items > total_line_items * 0.1::DOUBLE AS quality_alert_flag,
  avg_line_items_per_transaction AS actual_line_items_per_txn_ratio, {mt(pct('duplicate_txn_product_line_items'))} AS duplicate_line_item_pct,
  {NOW} AS profile_created_at, 'RETAIL_S3' AS source_system, 'line_item' AS grain_level
FROM staging_profile
"""
CTES["lines_marked"] = """
SELECT *, date_trunc('day', intermediate_processed_at) AS profile_date,
  ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY product_id NULLS LAST, line_item_key) AS line_no FROM intmd_transactions
"""
CTES["lines_daily"] = f"""
SELECT profile_date, COUNT(*) AS total_line_items, COUNT(DISTINCT line_item_key) AS unique_line_items, COUNT(DISTINCT transaction_id) AS unique_transactions,
  COUNT(DISTINCT customer_id) AS unique_customers, COUNT(DISTINCT product_id) AS unique_products_sold, COUNT(DISTINCT store_id) AS unique_stores,
  COUNT(DISTINCT payment_method) AS unique_payment_methods, {n_if("data_quality_status = 'CLEAN'")} AS clean_records,
  {n_if("data_quality_status = 'CORRECTED'")} AS corrected_records, {n_if("data_quality_status = 'INCOMPLETE'")} AS incomplete_records,
  {mt('SUM(line_total_clean)', 4)} AS total_line_item_revenue, {mt('AVG(line_total_clean)', 4)} AS avg_line_item_value,
  {s('quantity_clean')} AS total_quantity_sold, {mt('AVG(quantity_clean)', 4)} AS avg_quantity_per_line,
  {n_if('is_refund')} AS refund_line_items, {n_if('has_promotion')} AS promotion_line_items, {n_if('has_discount')} AS discount_line_items,
  {n_if('is_bulk_purchase')} AS bulk_purchase_line_items, {n_if('is_high_value_item')} AS high_value_line_items, {n_if('is_weekend')} AS weekend_transactions,
  {n_if('earned_loyalty_points')} AS transactions_with_loyalty_points, {n_if("transaction_type = 'Regular Sale'")} AS regular_sale_items,
  {n_if("transaction_type = 'Discounted'")} AS discounted_items, {n_if("transaction_type = 'Refund'")} AS refund_items,
  {n_if("transaction_type IN ('Promotion', 'Promotional Sale')")} AS promotional_items, {n_if("time_of_day LIKE 'Morning%'")} AS morning_transactions,
  {n_if("time_of_day LIKE 'Afternoon%'")} AS afternoon_transactions, {n_if("time_of_day LIKE 'Evening%'")} AS evening_transactions,
  {mt('AVG(discount_percent)', 4)} AS avg_discount_percent, {mt('SUM(discount_amount)', 4)} AS total_discount_amount,
  {s('loyalty_points_earned')} AS total_loyalty_points_earned, {mt('SUM(CASE WHEN line_no = 1 THEN total_amount ELSE 0 END)', 4)} AS total_transaction_revenue
FROM lines_marked GROUP BY profile_date
"""
CTES["lines_profile"] = f"""
SELECT *, {mt(pct('total_line_items', 'unique_transactions') + ' / 100.0')} AS avg_items_per_transaction, {mt(pct('clean_records'))} AS clean_pct,
  {mt(pct('corrected_records'))} AS corrected_pct, {mt(pct('refund_line_items'))} AS refund_pct, {mt(pct('promotion_line_items'))} AS promotion_pct,
  {mt(pct('weekend_transactions'))} AS weekend_pct,
  {mt("GREATEST(0.0::DOUBLE, 100.0::DOUBLE - corrected_records * 5.0::DOUBLE / total_line_items - incomplete_records * 10.0::DOUBLE / total_line_items - refund_line_items * 2.0::DOUBLE / total_line_items)", 4)} AS transaction_intermediate_quality_score
FROM lines_daily
"""
CTES["lines_grades"] = f"""
SELECT *, CASE WHEN total_line_items = unique_line_items THEN 'Perfect - No Duplicates' ELSE 'WARNING - Duplicates Found' END AS deduplication_status,
  {baskets('avg_items_per_transaction')} AS transaction_size_health,
  CASE WHEN transaction_intermediate_quality_score < 90 THEN 'Needs Review' WHEN transaction_intermediate_quality_score < 95 THEN 'Fair'
    WHEN transaction_intermediate_quality_score < 98 THEN 'Good' ELSE 'Excellent' END AS health_status,
  CASE WHEN clean_pct < 85 THEN 'NEEDS_IMPROVEMENT' WHEN clean_pct < 90 THEN 'ACCEPTABLE_QUALITY' WHEN clean_pct < 95 THEN 'GOOD_QUALITY' ELSE 'HIGH_QUALITY' END AS quality_tier,
  CASE WHEN refund_pct <= 5 THEN 'NORMAL_REFUNDS' WHEN refund_pct <= 10 THEN 'ELEVATED_REFUNDS' ELSE 'HIGH_REFUNDS' END AS refund_health,
  CASE WHEN promotion_pct <= 20 THEN 'LOW_PROMOTIONS' WHEN promotion_pct <= 40 THEN 'MODERATE_PROMOTIONS' ELSE 'HEAVY_PROMOTIONS' END AS promotion_intensity,
  transaction_intermediate_quality_score < 90 OR clean_pct < 90 OR refund_pct > 10 OR total_line_items < 1000 AS quality_alert_flag,
  {mt(pct('unique_line_items'))} AS deduplication_success_pct, {NOW} AS profile_created_at, 'transaction' AS entity_type, 'line_item' AS grain_level
FROM lines_profile
"""

CTES["dim_rows"] = """
SELECT 'dim_customers' AS dimension, COUNT(*) AS row_count FROM dim_customers UNION ALL SELECT 'dim_products', COUNT(*) FROM dim_products
UNION ALL SELECT 'dim_stores', COUNT(*) FROM dim_stores UNION ALL SELECT 'dim_date', DATE '2031-01-01' - DATE '2020-01-01'
"""
CTES["fact_stats"] = f"""
SELECT COUNT(*) AS total_sales, COUNT(DISTINCT customer_key) AS unique_customers, COUNT(DISTINCT product_key) AS unique_products,
  COUNT(DISTINCT store_key) AS unique_stores, {mt('SUM(line_total)')} AS total_revenue, {mt('SUM(line_profit)')} AS total_profit,
  MIN(transaction_date) AS earliest_date, MAX(transaction_date) AS latest_date
FROM fact_sales WHERE NOT is_refund
"""
CTES["orphans"] = """
SELECT COUNT(*) - COUNT(customer_key) AS orphan_customers, COUNT(*) - COUNT(product_key) AS orphan_products, COUNT(*) - COUNT(store_key) AS orphan_stores
FROM looked_up
"""


def rows_of(dim: str) -> str:
    return f"(SELECT row_count FROM dim_rows WHERE dimension = 'dim_{dim}')"


CTES["gold"] = f"""
SELECT {rows_of('customers')} AS dim_customers_count, {rows_of('products')} AS dim_products_count, {rows_of('stores')} AS dim_stores_count,
  {rows_of('date')} AS dim_date_count, total_sales, total_revenue, orphan_customers, orphan_products, orphan_stores,
  CAST({AS_OF} - latest_date AS INTEGER) AS days_old,
  100.0::DOUBLE - CASE WHEN orphan_customers > 100 THEN 10 ELSE 0 END - CASE WHEN orphan_products > 100 THEN 10 ELSE 0 END
    - CASE WHEN orphan_stores > 100 THEN 10 ELSE 0 END - CASE WHEN {AS_OF} - latest_date > 7 THEN 5 ELSE 0 END AS quality_score,
  {rows_of('date')} = 4018 AS calendar_complete,
  {rows_of('customers')} >= 1000 AND {rows_of('products')} >= 100 AND {rows_of('stores')} >= 10 AND total_sales >= 1000 AS passed
FROM fact_stats CROSS JOIN orphans
"""

CENTS = "CAST(SUM(CAST(round_even({0} * 100, 0) AS BIGINT)) AS BIGINT)"
CTES["sale_days"] = f"""
SELECT transaction_date AS date, {CENTS.format('line_total')} / 100.0::DOUBLE AS revenue, {CENTS.format('total_cost')} / 100.0::DOUBLE AS cost,
  COUNT(DISTINCT transaction_id) AS transactions, COUNT(DISTINCT customer_key) AS customers, CAST(SUM(quantity) AS BIGINT) AS units_sold
FROM fact_sales WHERE NOT is_refund GROUP BY transaction_date
"""
CTES["sale_spine"] = """
SELECT CAST(g.d AS DATE) AS date, COALESCE(revenue, 0) AS revenue, COALESCE(cost, 0) AS cost, COALESCE(transactions, 0) AS transactions, customers, units_sold
FROM (SELECT UNNEST(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS d FROM sale_days) g LEFT JOIN sale_days x ON x.date = CAST(g.d AS DATE)
"""
CTES["sale_windows"] = f"""
SELECT *, {mt('revenue - LAG(revenue, 1) OVER w')} AS revenue_change_vs_yesterday, {mt('revenue - LAG(revenue, 7) OVER w')} AS revenue_change_vs_last_week,
  {mt('AVG(revenue) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS revenue_7day_avg,
  {mt('AVG(revenue) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)')} AS revenue_30day_avg,
  {mt('SUM(revenue) OVER (PARTITION BY year(date), month(date) ORDER BY date)')} AS revenue_mtd,
  {mt('SUM(revenue) OVER (PARTITION BY year(date) ORDER BY date)')} AS revenue_ytd
FROM sale_spine WINDOW w AS (ORDER BY date)
"""
CTES["revenue_performance"] = f"""
SELECT date, {i('year(date)')} AS year, {i('quarter(date)')} AS quarter, {i('month(date)')} AS month, monthname(date) AS month_name, dayname(date) AS day_name,
  CASE WHEN isodow(date) > 5 THEN 'Weekend' ELSE 'Weekday' END AS day_type, revenue, cost, {mt('revenue - cost')} AS profit,
  {mt('(revenue - cost) / NULLIF(revenue, 0) * 100')} AS profit_margin_pct, transactions, customers, units_sold, {mt('revenue / transactions')} AS avg_order_value,
  revenue_change_vs_yesterday, revenue_change_vs_last_week, revenue_7day_avg, revenue_30day_avg, revenue_mtd, revenue_ytd,
  date = {AS_OF} AS is_today, date BETWEEN {AS_OF} - 6 AND {AS_OF} AS is_last_7_days, date BETWEEN {AS_OF} - 29 AND {AS_OF} AS is_last_30_days
FROM sale_windows WHERE transactions > 0
"""


def totals(k: str) -> str:
    return f"""
SELECT {k}, {CENTS.format('line_total')} AS revenue_cents, {CENTS.format('line_profit')} AS profit_cents, COUNT(DISTINCT transaction_id) AS total_transactions,
  COUNT(DISTINCT customer_key) AS buyers, COUNT(DISTINCT transaction_date) AS days_with_sales, CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
  {mt('AVG(line_total / NULLIF(quantity, 0))')} AS avg_actual_price, MIN(transaction_date) AS first_sale_date, MAX(transaction_date) AS last_sale_date
FROM fact_sales WHERE NOT is_refund GROUP BY {k}"""


CTES["store_totals"] = totals("store_key")
CTES["product_totals"] = totals("product_key")
CTES["store_ranked"] = """
SELECT t.*, COALESCE(store_id, 'Unknown') AS store_id, COALESCE(store_name, 'Unknown') AS store_name, COALESCE(city, 'Unknown') AS city,
  COALESCE(state, 'Unknown') AS state, manager, revenue_cents / 100.0::DOUBLE AS r, profit_cents / 100.0::DOUBLE AS p,
  RANK() OVER (ORDER BY revenue_cents DESC) AS revenue_rank, RANK() OVER (ORDER BY profit_cents DESC) AS profit_rank,
  RANK() OVER (PARTITION BY COALESCE(region, 'Unknown') ORDER BY revenue_cents DESC) AS rank_in_region,
  PERCENT_RANK() OVER (ORDER BY revenue_cents DESC) AS pr
FROM store_totals t LEFT JOIN dim_stores USING (store_key)
"""
CTES["store_performance"] = f"""
SELECT store_id, store_name, city, state, manager, {mt('r')} AS total_revenue, {mt('p')} AS total_profit, {mt('p / NULLIF(r, 0) * 100')} AS profit_margin_pct,
  total_transactions, buyers AS total_customers, total_units_sold, {mt('r / days_with_sales')} AS avg_daily_revenue,
  {mt('total_transactions / days_with_sales')} AS avg_daily_transactions, {mt('r / buyers')} AS revenue_per_customer,
  {mt('total_transactions / buyers')} AS transactions_per_customer, revenue_rank, profit_rank, rank_in_region,
  CASE WHEN revenue_rank <= 3 THEN 'Top 3' WHEN pr <= 0.25 THEN 'Top 25%' WHEN pr <= 0.5 THEN 'Above Average' WHEN pr <= 0.75 THEN 'Below Average'
    ELSE 'Bottom 25%' END AS performance_tier,
  CASE WHEN {mt('p / NULLIF(r, 0) * 100')} >= 40 THEN 'Excellent Margin' WHEN {mt('p / NULLIF(r, 0) * 100')} >= 25 THEN 'Good Margin'
    WHEN {mt('p / NULLIF(r, 0) * 100')} >= 10 THEN 'Fair Margin' ELSE 'Low Margin' END AS margin_status,
  first_sale_date, last_sale_date, days_with_sales, {i(f'{AS_OF} - last_sale_date')} AS days_since_last_sale
FROM store_ranked
"""
CTES["product_ranked"] = f"""
SELECT t.*, product_id, product_name, category, subcategory, brand, selling_price, cost_price, revenue_cents / 100.0::DOUBLE AS r, profit_cents / 100.0::DOUBLE AS p,
  RANK() OVER (ORDER BY revenue_cents DESC) AS revenue_rank, RANK() OVER (ORDER BY profit_cents DESC) AS profit_rank,
  RANK() OVER (ORDER BY total_units_sold DESC) AS units_rank, RANK() OVER (PARTITION BY category ORDER BY revenue_cents DESC) AS rank_in_category,
  PERCENT_RANK() OVER (ORDER BY revenue_cents DESC) AS pr,
  CAST(SUM(revenue_cents) OVER (ORDER BY revenue_cents DESC) AS DOUBLE) / CAST(SUM(revenue_cents) OVER () AS DOUBLE) AS share
FROM product_totals t JOIN dim_products USING (product_key)
"""
CTES["products_performance"] = f"""
SELECT product_id, product_name, category, subcategory, brand, selling_price AS list_price, cost_price, avg_actual_price, {mt('r')} AS total_revenue,
  {mt('p')} AS total_profit, {mt('p / NULLIF(r, 0) * 100')} AS profit_margin_pct, total_units_sold, total_transactions, buyers AS unique_customers,
  {mt('r / days_with_sales')} AS avg_daily_revenue, {mt('total_units_sold / days_with_sales')} AS avg_daily_units, {mt('r / buyers')} AS revenue_per_customer,
  {mt('total_units_sold / buyers')} AS units_per_customer, revenue_rank, profit_rank, units_rank, rank_in_category,
  CASE WHEN revenue_rank <= 10 THEN 'Top 10' WHEN pr <= 0.2 THEN 'Top 20%' WHEN pr <= 0.5 THEN 'Top 50%' ELSE 'Bottom 50%' END AS performance_tier,
  CASE WHEN share <= 0.8 THEN 'A - Top Products' WHEN share <= 0.95 THEN 'B - Medium Products' ELSE 'C - Low Products' END AS abc_class,
  CASE WHEN p < 0 THEN 'Loss Maker' WHEN {mt('p / NULLIF(r, 0) * 100')} >= 40 THEN 'High Margin Winner' WHEN pr <= 0.2 THEN 'Volume Driver' ELSE 'Profitable' END AS profit_status,
  CASE WHEN {AS_OF} - last_sale_date <= 7 THEN 'Hot Seller' WHEN {AS_OF} - last_sale_date <= 30 THEN 'Active' WHEN {AS_OF} - last_sale_date <= 90 THEN 'Slow Moving'
    ELSE 'Dormant' END AS sales_velocity,
  first_sale_date, last_sale_date, days_with_sales, {i(f'{AS_OF} - last_sale_date')} AS days_since_last_sale
FROM product_ranked
"""
CTES["customer_totals"] = f"""
SELECT customer_key, COUNT(DISTINCT transaction_id) AS n, COUNT(DISTINCT transaction_date) AS days_purchased,
  COUNT(DISTINCT date_trunc('month', transaction_date)) AS months_active, {mt('SUM(line_total)')} AS r,
  MIN(transaction_date) AS a, MAX(transaction_date) AS b FROM fact_sales WHERE NOT is_refund GROUP BY customer_key
"""
GAP = "(CAST(b - a AS DOUBLE) / NULLIF(days_purchased - 1, 0))"
CTES["customer_metrics"] = f"""
SELECT customer_id, full_name, customer_segment, age_group, city, state, n AS total_purchases, days_purchased, months_active, r AS lifetime_revenue,
  {mt('r / n')} AS avg_purchase_value, a AS first_purchase_date, b AS last_purchase_date, registration_date, {i('b - a')} AS customer_lifespan_days,
  {i(f'{AS_OF} - b')} AS days_since_last_purchase, {mt('n / months_active')} AS purchases_per_month,
  CASE WHEN n > 10 THEN 'VIP Buyer (10+ purchases)' WHEN n > 5 THEN 'Frequent Buyer (6-10 purchases)' WHEN n > 2 THEN 'Regular Buyer (3-5 purchases)'
    WHEN n = 2 THEN 'Occasional Buyer (2 purchases)' ELSE 'One-Time Buyer' END AS buyer_type,
  CASE WHEN {AS_OF} - b > 90 THEN 'Inactive (90+ days)' WHEN {AS_OF} - b > 60 THEN 'At Risk (60-90 days)' WHEN {AS_OF} - b > 30 THEN 'Recent (Last 60 days)'
    ELSE 'Active (Last 30 days)' END AS activity_status,
  CASE WHEN r < 100 THEN 'Very Low Value (<$100)' WHEN r < 500 THEN 'Low Value ($100-$500)' WHEN r < 1000 THEN 'Medium Value ($500-$1000)'
    ELSE 'High Value ($1000+)' END AS value_tier,
  CASE WHEN n = 1 THEN 'Single Purchase' WHEN days_purchased = 1 THEN 'Same Day Purchases' WHEN {GAP} <= 10 THEN 'Weekly Buyer'
    WHEN {GAP} <= 45 THEN 'Monthly Buyer' ELSE 'Irregular Buyer' END AS purchase_pattern
FROM customer_totals JOIN dim_customers USING (customer_key)
"""
