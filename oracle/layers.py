"""Oracle CTEs of the staging, intermediate and mart layers."""

from __future__ import annotations

from oracle.ctes import AS_OF, CTES, NOW, m
from tillhouse.functions import buckets, text

CLEAN = r"TRIM(REGEXP_REPLACE({0}, '[^\x20-\x7E]', '', 'g'))"
BARE = "REGEXP_REPLACE({0}, '[-().]', '', 'g')"
DIGITS = "REGEXP_REPLACE({0}, '[^0-9]', '', 'g')"
FIRST_NON_DIGIT = "REGEXP_REPLACE({0}, '[^0-9]', '')"


def clean(c: str) -> str:
    return CLEAN.format(c)


def blank(c: str) -> str:
    return f"({c} IS NULL OR TRIM({c}) = '')"


def fl(test: str) -> str:
    return f"CASE WHEN {test} THEN 1 ELSE 0 END"


def holds(test: str) -> str:
    return f"COALESCE({test}, FALSE)"


def safe_date(c: str) -> str:
    return f"TRY_CAST(NULLIF(TRIM({c}), '') AS DATE)"


def months(d: str) -> str:
    return f"DATE_DIFF('month', {d}, {AS_OF})"


def years(d: str) -> str:
    return f"DATE_DIFF('year', {d}, {AS_OF})"


def days(d: str) -> str:
    return f"DATE_DIFF('day', {d}, {AS_OF})"


def email(c: str) -> str:
    fixed = f"LOWER(TRIM(REPLACE({c}, ' at ', '@')))"
    return f"CASE WHEN TRIM({c}) <> '' AND {fixed} LIKE '%@%.%' THEN {fixed} END"


def country_code(c: str) -> str:
    b = BARE.format(c)
    return f"CASE WHEN CONTAINS({b}, '+1') OR {b} LIKE '001%' THEN '+1' END"


def extension(c: str) -> str:
    return f"CASE WHEN CONTAINS({c}, 'x') THEN SPLIT_PART({c}, 'x', 2) END"


def subscriber(c: str) -> str:
    b = BARE.format(c)
    us = f"({b} LIKE '+1%' OR {b} LIKE '001%')"
    odd = f"({b} LIKE '+%' OR {b} LIKE '001%')"
    x = f"CONTAINS({b}, 'x')"
    return f"""CASE WHEN {c} IS NULL THEN NULL
        WHEN {us} AND {x} THEN REGEXP_EXTRACT({b}, '^(?:\\+1|001)(\\d+?)x', 1)
        WHEN {us} THEN REGEXP_REPLACE({b}, '^(?:\\+1|001)', '')
        WHEN {x} AND NOT {odd} THEN REGEXP_EXTRACT({b}, '^(\\d+?)x', 1)
        ELSE {b} END"""


def street(c: str) -> str:
    return f"""CASE WHEN {blank(c)} THEN NULL WHEN CONTAINS({c}, chr(10)) THEN TRIM(SPLIT_PART({c}, chr(10), 1))
        ELSE TRIM(SPLIT_PART({c}, ',', 1)) END"""


def age_group(a: str) -> str:
    return f"""CASE WHEN {a} < 18 THEN 'Under 18' WHEN {a} BETWEEN 18 AND 24 THEN '18-24' WHEN {a} BETWEEN 25 AND 34 THEN '25-34'
        WHEN {a} BETWEEN 35 AND 44 THEN '35-44' WHEN {a} BETWEEN 45 AND 54 THEN '45-54' WHEN {a} BETWEEN 55 AND 64 THEN '55-64' ELSE '65+' END"""


def one_of(c: str, groups: dict[str, list[str]], default: str | None) -> str:
    """A CASE over the fixed code lists."""
    tests = " ".join(f"WHEN {c} IN ({', '.join(repr(v) for v in codes)}) THEN '{label}'" for label, codes in groups.items())
    return f"CASE {tests} ELSE {'NULL' if default is None else repr(default)} END"


def spellings(mapping: dict[str, str]) -> dict[str, list[str]]:
    groups: dict[str, list[str]] = {}
    for spelling, label in mapping.items():
        groups.setdefault(label, []).append(spelling)
    return groups


def gender(c: str) -> str:
    return one_of(f"UPPER(TRIM({c}))", spellings(text.GENDERS), None)


def contact(c: str) -> str:
    return one_of(f"UPPER(TRIM({c}))", spellings(text.CONTACTS), None)


def segment(c: str) -> str:
    return one_of(f"UPPER(TRIM({c}))", spellings(text.SEGMENTS), "Unknown")


def tenure_months(d: str) -> str:
    x = months(d)
    return f"""CASE WHEN {d} IS NULL OR {x} < 1 THEN 'New (< 3 months)' WHEN {x} < 12 THEN 'Recent (3-12 months)'
        WHEN {x} <= 24 THEN 'Established (1-2 years)' ELSE 'Loyal (2+ years)' END"""


def tenure_days(x: str) -> str:
    return f"""CASE WHEN {x} IS NULL OR {x} >= 730 THEN 'Loyal (2+ years)' WHEN {x} >= 365 THEN 'Established (1-2 years)'
        WHEN {x} >= 90 THEN 'Recent (3-12 months)' ELSE 'New (< 3 months)' END"""


def ltv_tier(v: str) -> str:
    return f"""CASE WHEN {v} IS NULL THEN 'Very Low Value' WHEN {v} < 0 THEN 'Negative' WHEN {v} < 500 THEN 'Very Low Value'
        WHEN {v} < 2000 THEN 'Low Value' WHEN {v} < 5000 THEN 'Medium Value' ELSE 'High Value' END"""


def ltv_category(v: str) -> str:
    return f"""CASE WHEN {v} IS NULL OR {v} < 0 THEN 'Negative' WHEN {v} < 500 THEN 'Very Low Value'
        WHEN {v} < 2000 THEN 'Low Value' WHEN {v} < 5000 THEN 'Medium Value' ELSE 'High Value' END"""


def maturity_months(d: str) -> str:
    x = months(d)
    return f"""CASE WHEN {d} IS NULL THEN 'Unknown' WHEN {x} > 24 THEN 'Mature (2+ years)' WHEN {x} > 12 THEN 'Established (1-2 years)'
        WHEN {x} > 3 THEN 'Current (< 1 year)' WHEN {x} >= 1 THEN 'Recent (1-3 months)' ELSE 'New (< 1 month)' END"""


def maturity_days(x: str) -> str:
    return f"""CASE WHEN {x} IS NULL THEN 'Unknown' WHEN {x} >= 730 THEN 'Mature (2+ years)' WHEN {x} >= 365 THEN 'Established (1-2 years)'
        WHEN {x} >= 90 THEN 'Current (< 1 year)' WHEN {x} >= 30 THEN 'Recent (1-3 months)' ELSE 'New (< 1 month)' END"""


def weight_incl(w: str) -> str:
    return f"""CASE WHEN {w} > 25 THEN 'Very Heavy (25+ kg)' WHEN {w} > 5 THEN 'Heavy (5-25 kg)' WHEN {w} >= 1 THEN 'Medium (1-5 kg)'
        WHEN {w} IS NULL THEN 'Unknown' ELSE 'Light (< 1 kg)' END"""


def weight_excl(w: str) -> str:
    return f"""CASE WHEN {w} >= 25 THEN 'Very Heavy (25+ kg)' WHEN {w} >= 5 THEN 'Heavy (5-25 kg)' WHEN {w} >= 1 THEN 'Medium (1-5 kg)'
        WHEN {w} IS NULL THEN 'Unknown' ELSE 'Light (< 1 kg)' END"""


def margin_pct(p: str, c: str) -> str:
    return f"CASE WHEN {p} > 0 AND {c} >= 0 THEN {m(f'({p} - {c}) / {p} * 100')} END"


def margin_incl(x: str) -> str:
    return f"""CASE WHEN {x} > 50 THEN 'High Margin (50%+)' WHEN {x} > 25 THEN 'Good Margin (25-50%)'
        WHEN {x} >= 10 THEN 'Moderate Margin (10-25%)' WHEN {x} < 10 THEN 'Low Margin (< 10%)' ELSE 'Unknown' END"""


def margin_excl(x: str) -> str:
    return f"""CASE WHEN {x} >= 50 THEN 'High Margin (50%+)' WHEN {x} >= 25 THEN 'Good Margin (25-50%)'
        WHEN {x} >= 10 THEN 'Moderate Margin (10-25%)' WHEN {x} < 10 THEN 'Low Margin (< 10%)' ELSE 'Unknown' END"""


def price_tier(p: str) -> str:
    return f"""CASE WHEN {p} IS NULL OR {p} <= 0 THEN 'Invalid' WHEN {p} < 10 THEN 'Economy' WHEN {p} < 100 THEN 'Budget'
        WHEN {p} < 1000 THEN 'Mid-Range' ELSE 'Premium' END"""


def stock_status(s: str) -> str:
    return f"""CASE WHEN {s} IS NULL THEN 'Unknown' WHEN {s} = 0 THEN 'Out of Stock' WHEN {s} >= 50 THEN 'In Stock'
        WHEN {s} >= 10 THEN 'Available' ELSE 'Low Stock' END"""


def store_age(d: str) -> str:
    x = days(d)
    return f"""CASE WHEN {d} IS NULL THEN 'Unknown' WHEN {x} < 0 THEN 'Not Yet Opened' WHEN {x} >= 1825 THEN 'Mature (5+ years)'
        WHEN {x} >= 1095 THEN 'Established (3-5 years)' WHEN {x} >= 365 THEN 'Young (1-3 years)' ELSE 'New (< 1 year)' END"""


def store_maturity(y: str) -> str:
    return f"""CASE WHEN {y} IS NULL THEN 'Unknown' WHEN {y} >= 10 THEN 'Legacy' WHEN {y} >= 5 THEN 'Mature' WHEN {y} >= 3 THEN 'Established'
        WHEN {y} >= 1 THEN 'Growing' ELSE 'Brand New' END"""


def store_category(t: str) -> str:
    return one_of(t, buckets.STORE_CATEGORIES, "Standard")


def region(s: str) -> str:
    return one_of(s, buckets.REGIONS, "Other")


METRO = ", ".join(repr(c) for c in buckets.METRO_CITIES)


def day_part(h: str) -> str:
    return f"""CASE WHEN {h} IS NULL THEN 'Unknown' WHEN {h} > 20 THEN 'Night (9-11pm)' WHEN {h} > 16 THEN 'Evening (5-8pm)'
        WHEN {h} > 11 THEN 'Afternoon (12-4pm)' WHEN {h} > 5 THEN 'Morning (6-11am)' ELSE 'Late Night (12-5am)' END"""


def txn_type(pct: str) -> str:
    return f"""CASE WHEN is_refund THEN 'Refund' WHEN has_promotion THEN CASE WHEN {pct} > 25 THEN 'Promotional Sale' ELSE 'Promotion' END
        WHEN {pct} > 25 THEN 'Deep Discount' WHEN {pct} > 0 THEN 'Discounted' ELSE 'Regular Sale' END"""


def txt(c: str) -> str:
    return f"CAST(CAST({c} + 0.0 AS DECIMAL(18,2)) AS VARCHAR)"


def row_hash(*cols: str) -> str:
    return "MD5(" + " || '|' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in cols) + ")"


def key(*cols: str) -> str:
    return "MD5(" + " || '-' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for c in cols) + ")"


def audit(table: str) -> str:
    return f"'batch-20011231' AS staging_batch_id, 'RETAIL_S3' AS _source_system, 'raw_{table}' AS _source_table"


def mismatch(part: str) -> str:
    return fl(f"address IS NOT NULL AND {part} IS NOT NULL AND NOT CONTAINS(address, {part})")


MISMATCHES = ", ".join(f"{mismatch(p)} AS address_{a}_mismatch_flag" for p, a in (("city", "city"), ("state", "state"), ("zip_code", "zip")))


def missing(*cols: str) -> str:
    return ", ".join(f"{fl(blank(c))} AS missing_{c}_flag" for c in cols)


CTES["stg_customers"] = f"""
SELECT customer_id, {clean('first_name')} AS first_name, first_name AS raw_first_name, {clean('last_name')} AS last_name,
  last_name AS raw_last_name, {clean('first_name')} || ' ' || {clean('last_name')} AS full_name, {email('email')} AS email,
  phone AS raw_phone_number, {country_code('phone')} AS country_code, {subscriber('phone')} AS phone, {extension('phone')} AS extension,
  {fl(f"{blank(subscriber('phone'))} OR LENGTH({DIGITS.format(subscriber('phone'))}) < 7")} AS invalid_phone_flag,
  {street('address')} AS street_address, address AS address_raw, TRIM(city) AS city, TRIM(state) AS state, TRIM(zip_code) AS zip_code,
  {fl('zip_code NOT IN (SELECT zip_code FROM zip_lookup)')} AS invalid_zip_code_flag,
  CASE WHEN EXISTS (SELECT 1 FROM zip_lookup z WHERE z.zip_code = r.zip_code AND z.state_name = r.state) THEN 0 ELSE 1 END AS state_zip_mismatch_flag,
  {MISMATCHES}, {missing('city', 'state', 'zip_code', 'email', 'phone')},
  {safe_date('date_of_birth')} AS date_of_birth, CAST({years(safe_date('date_of_birth'))} AS INTEGER) AS age,
  {age_group(years(safe_date('date_of_birth')))} AS age_group, {gender('gender')} AS gender,
  {safe_date('registration_date')} AS registration_date, CAST({days(safe_date('registration_date'))} AS INTEGER) AS days_since_registration,
  {tenure_months(safe_date('registration_date'))} AS customer_tenure_category, COALESCE(loyalty_member, FALSE) AS loyalty_member,
  {contact('preferred_contact')} AS preferred_contact, {segment('customer_segment')} AS customer_segment, total_lifetime_value,
  {fl('total_lifetime_value < 0')} AS negative_ltv_flag, {ltv_tier('total_lifetime_value')} AS ltv_tier,
  {clean('first_name')} AS first_name_clean, {clean('last_name')} AS last_name_clean, modified_date AS raw_loaded_at,
  {NOW} AS staging_loaded_at,
  {row_hash('customer_id', 'first_name', 'last_name', 'email', subscriber('phone'), 'city', 'state', 'zip_code', txt('total_lifetime_value'))} AS _row_hash,
  {audit('customers')}
FROM raw_customers r
"""

CTES["product_names"] = f"SELECT DISTINCT product_id, product_name AS clean_name FROM raw_products WHERE {clean('product_name')} = product_name"
CTES["store_names"] = f"SELECT DISTINCT store_id, store_name AS clean_name FROM raw_stores WHERE {clean('store_name')} = store_name"
CTES["txn_store_names"] = f"SELECT DISTINCT store_id, store_name AS clean_name FROM raw_transactions WHERE {clean('store_name')} = store_name"

PRODUCT_FLAGS = ", ".join([
    f"{fl('stock_quantity < 0')} AS negative_stock_quantity_flag", f"{fl('stock_quantity IS NULL')} AS missing_stock_quantity_flag",
    f"{fl('stock_quantity = 0')} AS zero_stock_quantity_flag", f"{fl('stock_quantity > 0 AND stock_quantity < 10')} AS is_low_stock",
    f"{fl('price IS NULL OR price <= 0')} AS invalid_price_flag", f"{fl('cost IS NULL OR cost < 0')} AS invalid_cost_flag",
    f"{fl('cost > price')} AS cost_exceeds_price_flag", f"{fl('price > 10000')} AS very_high_price_flag",
    f"{fl('price > 0 AND price < 1')} AS very_low_price_flag", f"{fl('weight IS NULL')} AS missing_weight_flag",
    f"{fl('weight > 0 AND weight < 0.01::DOUBLE')} AS suspiciously_low_weight_flag", f"{fl('weight > 1000')} AS very_high_weight_flag",
])
CTES["stg_products"] = f"""
SELECT product_id, clean_name AS product_name, product_name AS product_name_raw, {clean('category')} AS category,
  {clean('subcategory')} AS subcategory, {clean('brand')} AS brand, TRIM(sku) AS sku, {m('price')} AS selling_price, price AS selling_price_raw,
  {m('cost')} AS cost_price, cost AS cost_price_raw, weight, dimensions, CASE WHEN stock_quantity >= 0 THEN stock_quantity END AS stock_quantity,
  stock_quantity AS stock_quantity_raw, {clean('supplier')} AS supplier, {safe_date('launch_date')} AS launch_date,
  {fl(f"{safe_date('launch_date')} > {AS_OF}")} AS is_upcoming, {maturity_months(safe_date('launch_date'))} AS product_maturity,
  {missing('product_name', 'category', 'sku', 'supplier', 'dimensions', 'launch_date')}, {PRODUCT_FLAGS},
  {weight_incl('weight')} AS weight_category, {fl(f"{safe_date('launch_date')} > {AS_OF}")} AS future_launch_date_flag,
  {margin_pct('price', 'cost')} AS profit_margin_pct, {margin_incl(margin_pct('price', 'cost'))} AS margin_tier,
  {price_tier('price')} AS price_tier, {stock_status('stock_quantity')} AS stock_status,
  CAST(CASE WHEN {safe_date('launch_date')} <= {AS_OF} THEN {days(safe_date('launch_date'))} END AS INTEGER) AS days_since_launch,
  modified_date AS raw_loaded_at, {NOW} AS staging_loaded_at,
  {row_hash('clean_name', 'category', 'subcategory', 'brand', txt('price'), txt('cost'), 'sku', 'stock_quantity', 'supplier', 'launch_date')} AS _row_hash,
  {audit('products')}
FROM raw_products JOIN product_names USING (product_id)
"""

CTES["stg_stores"] = f"""
SELECT store_id, clean_name AS store_name, store_name AS store_name_raw, {street('address')} AS store_address, address AS store_address_raw,
  {clean('city')} AS city, {clean('state')} AS state, TRIM(zip_code) AS zip_code,
  REGEXP_REPLACE(phone, '[^0-9x+()-]', '', 'g') AS store_phone, phone AS store_phone_raw, TRIM(manager) AS manager,
  UPPER(TRIM(store_type)) AS store_type, {safe_date('opening_date')} AS opening_date,
  CAST(CASE WHEN {safe_date('opening_date')} <= {AS_OF} THEN {days(safe_date('opening_date'))} END AS INTEGER) AS days_since_opening,
  CASE WHEN {safe_date('opening_date')} <= {AS_OF} THEN ROUND({days(safe_date('opening_date'))} / 365.25::DOUBLE, 0) END AS years_since_opening,
  {MISMATCHES}, {missing('city', 'state', 'zip_code', 'phone', 'manager', 'store_name', 'store_type', 'opening_date')},
  {fl(f"LENGTH({DIGITS.format('phone')}) < 10")} AS phone_too_short_flag,
  {fl(f"{safe_date('opening_date')} > {AS_OF}")} AS future_opening_date_flag,
  {fl(f"{years(safe_date('opening_date'))} > 20")} AS very_old_store_flag, {store_age(safe_date('opening_date'))} AS store_age_category,
  {holds(f"{safe_date('opening_date')} <= {AS_OF} AND phone IS NOT NULL AND manager IS NOT NULL")} AS is_fully_operational,
  modified_date AS raw_loaded_at, {NOW} AS staging_loaded_at,
  {row_hash('clean_name', 'address', 'city', 'state', 'zip_code', 'phone', 'manager', 'store_type', 'opening_date')} AS _row_hash,
  {audit('stores')}
FROM raw_stores JOIN store_names USING (store_id)
"""

ID_DAY = r"CAST(strptime(REGEXP_EXTRACT(transaction_id, 'TXN(\d{8})', 1), '%Y%m%d') AS DATE)"
DAY = f"CASE WHEN {blank('date')} THEN {ID_DAY} ELSE TRY_CAST(date AS DATE) END"
LINE = m("quantity * unit_price * (1 - discount_percent / 100)")
NOT_REFUNDED = "(status <> 'Refunded' OR refund_reason IS NULL)"
STAGED_AT = "CAST(date_trunc('month', data_created_modified) + INTERVAL 1 MONTH AS TIMESTAMP)"
CTES["stg_transactions"] = f"""
SELECT REPLACE(transaction_id, 'DUP', '') AS transaction_id_clean, transaction_id AS transaction_id_raw,
  REPLACE(transaction_id || '-' || product_id, 'DUP', '') AS transaction_product, {DAY} AS transaction_date,
  CASE WHEN {blank('time')} THEN '00:00:00' ELSE time END AS transaction_time,
  CASE WHEN {blank('date')} OR {blank('time')} THEN CAST({ID_DAY} AS TIMESTAMP) ELSE TRY_CAST(date || ' ' || time AS TIMESTAMP) END AS transaction_datetime,
  CAST(YEAR({DAY}) AS INTEGER) AS transaction_year, CAST(MONTH({DAY}) AS INTEGER) AS transaction_month, CAST(DAY({DAY}) AS INTEGER) AS transaction_day,
  CAST(DAYOFWEEK({DAY}) AS INTEGER) AS transaction_day_of_week,
  CAST(CASE WHEN NOT {blank('time')} THEN HOUR(CAST(time AS TIME)) END AS INTEGER) AS transaction_hour,
  customer_id, store_id, clean_name AS store_name, cashier_id, UPPER(TRIM(payment_method)) AS payment_method, UPPER(TRIM(status)) AS payment_status,
  (status = 'Refunded' OR refund_reason IS NOT NULL) AS is_refund, TRIM(refund_reason) AS refund_reason,
  UPPER(TRIM(promotion_code)) AS promotion_code, NOT {blank('promotion_code')} AS has_promotion,
  subtotal, tax_amount, total_amount, items_count, loyalty_points_earned, product_id, {clean('product_name')} AS product_name,
  TRIM(category) AS category, quantity, {m('unit_price')} AS unit_price, discount_percent,
  quantity * unit_price * (discount_percent / 100) AS discount_amount, {LINE} AS calculated_line_total, line_total,
  {fl('transaction_id IS NULL')} AS missing_transaction_id_flag, {missing('date', 'time', 'cashier_id', 'payment_method')},
  {fl('customer_id IS NULL')} AS missing_customer_id_flag, {fl('product_id IS NULL')} AS missing_product_id_flag,
  {fl(f'ABS({LINE} - line_total) > 100')} AS line_total_discrepancy_flag, {fl(f'quantity < 0 AND {NOT_REFUNDED}')} AS negative_quantity_flag,
  {fl(f'total_amount < 0 AND {NOT_REFUNDED}')} AS negative_amount_flag, {fl(f'line_total < 0 AND {NOT_REFUNDED}')} AS negative_line_total_flag,
  {fl('COALESCE(total_amount, 0) = 0')} AS zero_total_amount_flag, {fl('COALESCE(quantity, 0) = 0')} AS zero_quantity_flag,
  {fl('unit_price > 10000')} AS high_unit_price_flag, {fl('total_amount > 100000')} AS high_total_amount_flag,
  data_created_modified AS raw_loaded_at, {STAGED_AT} AS staging_processed_at,
  {row_hash('transaction_id', 'product_id', 'quantity', txt('unit_price'), txt('line_total'), txt('total_amount'), 'status')} AS _row_hash,
  {audit('transactions')}
FROM raw_transactions LEFT JOIN txn_store_names USING (store_id)
"""

CTES["intmd_customers_flagged"] = f"""
SELECT s.* EXCLUDE (invalid_zip_code_flag, state_zip_mismatch_flag), z.state_abrv AS state_code_from_zip, z.state_name AS state_name_from_zip,
  z.county_name, z.fips_code, z.cent_lat AS latitude, z.cent_long AS longitude,
  {fl('s.zip_code IS NOT NULL AND z.state_abrv IS NULL')} AS invalid_zip_code_flag,
  {fl('z.state_abrv IS NOT NULL AND s.state NOT IN (z.state_abrv, z.state_name)')} AS state_zip_mismatch_flag,
  {fl(f"LENGTH({FIRST_NON_DIGIT.format('s.phone')}) < 10")} AS phone_too_short_flag
FROM stg_customers s LEFT JOIN zip_lookup z ON s.zip_code = z.zip_code
WHERE missing_email_flag + missing_city_flag + missing_state_flag + missing_zip_code_flag = 0
  AND missing_phone_flag + negative_ltv_flag <= 2
"""
C12 = [
    "missing_email_flag", "missing_phone_flag", "missing_city_flag", "missing_state_flag", "missing_zip_code_flag", "negative_ltv_flag",
    "address_city_mismatch_flag", "address_state_mismatch_flag", "address_zip_mismatch_flag", "invalid_zip_code_flag",
    "state_zip_mismatch_flag", "phone_too_short_flag",
]
CTES["intmd_customers"] = f"""
SELECT customer_id, first_name, last_name, full_name, gender, date_of_birth, age, {age_group('age')} AS age_group, email, phone,
  CASE WHEN CONTAINS(phone, 'x') THEN REGEXP_EXTRACT(phone, 'x(\\d+)', 1) END AS phone_extension,
  {FIRST_NON_DIGIT.format("REGEXP_REPLACE(phone, 'x.*$', '')")} AS phone_digits_only,
  street_address, city, state, zip_code, state_code_from_zip, state_name_from_zip, county_name, fips_code, latitude, longitude,
  registration_date, days_since_registration, {tenure_days('days_since_registration')} AS customer_tenure_category, customer_segment,
  total_lifetime_value AS lifetime_value, {ltv_category('total_lifetime_value')} AS ltv_category, {', '.join(C12)},
  {' + '.join(C12)} AS quality_issues_count,
  CASE WHEN {' + '.join(C12)} > 2 THEN 'POOR' WHEN {' + '.join(C12)} > 0 THEN 'ACCEPTABLE' ELSE 'CLEAN' END AS quality_tier,
  staging_loaded_at, staging_batch_id, 'batch-20011231' AS intermediate_batch_id, _source_system, {NOW} AS intermediate_loaded_at, _row_hash
FROM intmd_customers_flagged
"""
CTES["intmd_products"] = f"""
SELECT product_id, product_name, category, subcategory, brand, sku, supplier, selling_price, cost_price, profit_margin_pct, price_tier,
  CASE WHEN very_high_price_flag = 1 THEN 'LUXURY' WHEN very_low_price_flag = 1 THEN 'CLEARANCE' ELSE 'STANDARD' END AS price_category,
  stock_quantity, stock_status, {holds('stock_quantity > 0')} AS is_available, {holds('stock_quantity = 0')} AS is_out_of_stock,
  {holds('stock_quantity BETWEEN 1 AND 9')} AS is_low_stock, weight, dimensions, {weight_excl('weight')} AS weight_category, launch_date,
  days_since_launch, {maturity_days('days_since_launch')} AS product_maturity, future_launch_date_flag = 1 AS is_upcoming,
  {margin_excl('profit_margin_pct')} AS margin_tier,
  CASE WHEN missing_sku_flag + missing_supplier_flag > 0 THEN 'BASIC'
       WHEN missing_weight_flag + missing_dimensions_flag + missing_launch_date_flag > 0 THEN 'GOOD' ELSE 'COMPLETE' END AS product_data_quality,
  staging_loaded_at, {NOW} AS intermediate_loaded_at, staging_batch_id, 'batch-20011231' AS intermediate_batch_id, _source_system, _row_hash
FROM stg_products
WHERE product_id IS NOT NULL
  AND missing_product_name_flag + invalid_price_flag + invalid_cost_flag + cost_exceeds_price_flag + missing_category_flag = 0
"""
CTES["intmd_stores"] = f"""
SELECT store_id, store_name, store_type, manager, store_address, city, state, zip_code,
  store_address || ', ' || city || ', ' || state || ' ' || zip_code AS full_address,
  CASE WHEN address_city_mismatch_flag + address_state_mismatch_flag + address_zip_mismatch_flag > 0 THEN 'INCONSISTENT' ELSE 'VALID' END AS address_quality,
  store_phone, opening_date, days_since_opening, years_since_opening, store_age_category, {store_maturity('years_since_opening')} AS store_maturity_tier,
  is_fully_operational, very_old_store_flag = 1 AS is_legacy_store, {store_category('store_type')} AS store_category, {region('state')} AS region,
  {holds(f'city IN ({METRO})')} AS is_metro_area,
  CASE WHEN address_city_mismatch_flag + address_state_mismatch_flag + address_zip_mismatch_flag > 0 THEN 'BASIC'
       WHEN missing_manager_flag = 1 THEN 'GOOD' ELSE 'COMPLETE' END AS store_data_quality,
  staging_loaded_at, {NOW} AS intermediate_loaded_at, staging_batch_id, 'batch-20011231' AS intermediate_batch_id, _source_system, _row_hash
FROM stg_stores
WHERE store_id IS NOT NULL AND missing_store_name_flag + missing_city_flag + missing_state_flag + missing_zip_code_flag + missing_phone_flag
  + phone_too_short_flag + missing_opening_date_flag + future_opening_date_flag = 0
"""
CTES["latest_lines"] = """
SELECT * FROM stg_transactions
QUALIFY ROW_NUMBER() OVER (PARTITION BY transaction_id_clean, product_id
  ORDER BY staging_processed_at DESC, is_refund, transaction_id_raw LIKE '%DUP%', raw_loaded_at DESC,
  quantity, unit_price, line_total, total_amount, customer_id, store_id) = 1
"""
CTES["admitted_lines"] = """
SELECT * FROM latest_lines
WHERE missing_transaction_id_flag + missing_date_flag + missing_customer_id_flag + missing_product_id_flag = 0
  AND (zero_total_amount_flag = 0 OR is_refund)
"""
CTES["intmd_transactions"] = f"""
SELECT {key('transaction_id_clean', 'product_id')} AS line_item_key, transaction_id_clean AS transaction_id, product_id, customer_id, store_id,
  store_name, cashier_id, transaction_date, transaction_time, transaction_datetime, transaction_year, transaction_month, transaction_day,
  transaction_day_of_week, transaction_hour, dayname(transaction_date) IN ('Saturday', 'Sunday') AS is_weekend, dayname(transaction_date) AS day_name,
  {day_part('transaction_hour')} AS time_of_day, payment_method, payment_status, subtotal, tax_amount, total_amount, items_count,
  loyalty_points_earned, product_name, category, quantity, unit_price, discount_percent, discount_amount, line_total,
  CASE WHEN NOT is_refund AND line_total < 0 THEN 0.0
       WHEN line_total = 0 AND quantity > 0 AND unit_price > 0 THEN quantity * unit_price * (1 - discount_percent / 100)
       ELSE line_total END AS line_total_clean,
  CASE WHEN is_refund THEN quantity ELSE ABS(quantity) END AS quantity_clean,
  is_refund, refund_reason, has_promotion, promotion_code, {holds('discount_percent > 0')} AS has_discount, {holds('quantity >= 2')} AS is_multi_quantity,
  {holds('quantity > 9')} AS is_bulk_purchase, {holds('line_total > 1000')} AS is_high_value_item, {holds('loyalty_points_earned > 0')} AS earned_loyalty_points,
  {txn_type('discount_percent')} AS transaction_type,
  CASE WHEN NOT is_refund AND negative_quantity_flag + negative_amount_flag + negative_line_total_flag + zero_total_amount_flag > 0 THEN 'CORRECTED'
       WHEN missing_time_flag + missing_cashier_id_flag > 0 THEN 'INCOMPLETE' ELSE 'CLEAN' END AS data_quality_status,
  negative_quantity_flag AS had_negative_quantity, negative_amount_flag AS had_negative_amount, zero_total_amount_flag AS had_zero_total,
  missing_time_flag AS had_missing_time, missing_cashier_id_flag AS had_missing_cashier, high_unit_price_flag AS had_high_unit_price,
  raw_loaded_at, staging_processed_at, staging_processed_at AS intermediate_processed_at, staging_batch_id,
  'batch-20011231' AS intermediate_batch_id, _source_system
FROM admitted_lines
"""
