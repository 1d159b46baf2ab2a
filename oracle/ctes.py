"""Named CTEs of the oracle and the helper that chains the ones a query needs."""

from __future__ import annotations

import re

NBSP, ZWSP, BAD = "\u00a0", "\u200b", "\ufffd"
AS_OF = "DATE '2001-12-31'"
NOW = "TIMESTAMP '2001-12-31 06:00:00'"

CTES: dict[str, str] = {}


def m(expr: str, places: int = 2) -> str:
    """Decimal rounding, row level."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(18,6)), {places}) AS DOUBLE)"


def mt(expr: str, places: int = 2) -> str:
    """Decimal rounding, aggregates."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(34,6)), {places}) AS DOUBLE)"


def pad(expr: str, width: int) -> str:
    return f"LPAD(CAST({expr} AS VARCHAR), {width}, '0')"


def pick(key: str, *values: str | None) -> str:
    items = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"([{items}])[({key}) % {len(values)} + 1]"


def day(start: str, offset: str) -> str:
    return f"CAST(DATE '{start}' + CAST({offset} AS INTEGER) AS VARCHAR)"


def phone(k: str) -> str:
    d = f"LPAD(CAST({k} AS VARCHAR), 10, '5')"
    dashed = f"{d}[1:3] || '-' || {d}[4:6] || '-' || {d}[7:10]"
    ext = f"'x' || CAST({k} % 1000 AS VARCHAR)"
    return f"""CASE {k} % 8 WHEN 0 THEN {d}
        WHEN 1 THEN '(' || {d}[1:3] || ')' || {d}[4:6] || '-' || {d}[7:10]
        WHEN 2 THEN '+1-' || {dashed} || {ext}
        WHEN 3 THEN '001-' || {dashed}
        WHEN 4 THEN REPLACE({dashed}, '-', '.') || {ext}
        WHEN 5 THEN '001-' || {dashed} || {ext}
        WHEN 6 THEN CASE WHEN {k} % 16 = 6 THEN '' END
        ELSE {d}[6:10] END"""


def address(k: str) -> str:
    street = f"CAST({k} AS VARCHAR) || ' Main St'"
    return f"""CASE WHEN {k} % 5 <= 1 THEN {street} || chr(10) || COALESCE(city, '') || ', ' || COALESCE(state, '') || ' ' || zip_code
        WHEN {k} % 5 = 2 THEN {street} || ', ' || COALESCE(city, '')
        WHEN {k} % 5 = 3 THEN {street}
        WHEN {k} % 10 = 4 THEN '' END"""


def with_ctes(sql: str) -> str:
    """Prefix ``sql`` with every CTE it mentions, directly or not."""
    needed: list[str] = []

    def visit(name: str) -> None:
        if name in needed:
            return
        for other in CTES:
            if other != name and re.search(rf"\b(?:FROM|JOIN|from|join)\s+{other}\b", CTES[name]):
                visit(other)
        if name not in needed:
            needed.append(name)

    for name in CTES:
        if re.search(rf"\b(?:FROM|JOIN|from|join)\s+{name}\b", sql):
            visit(name)
    if not needed:
        return sql
    body = ",\n".join(f"{n} AS ({CTES[n]})" for n in needed)
    inner = re.match(r"\s*WITH\s+", sql)
    if inner:
        return f"WITH {body},\n{sql[inner.end():]}"
    return f"WITH {body}\n{sql}"


K = "l_orderkey"
CTES["till_lines"] = f"""
SELECT *,
  CASE WHEN (l_returnflag = 'R' AND l_linestatus = 'F') OR (l_returnflag = 'A' AND {K} % 29 = 0)
       THEN -CAST(l_quantity AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END AS qty,
  {m('l_extendedprice / l_quantity')} AS price,
  CAST(CAST(ROUND(l_discount * 400) AS BIGINT) AS DOUBLE) AS pct,
  strftime(o_orderdate, '%Y-%m-%d') AS date_text,
  {pad(f'{K} % 15 + 8', 2)} || ':' || {pad('l_partkey % 60', 2)} || ':00' AS clock,
  CASE WHEN {K} % 41 = 0 THEN 0.0 ELSE o_totalprice END AS total
FROM lineitem JOIN orders ON l_orderkey = o_orderkey,
  LATERAL (SELECT UNNEST(CASE WHEN ({K} + l_linenumber) % 7 = 0 THEN ['', 'DUP'] ELSE [''] END) AS copy)
"""
CTES["raw_transactions"] = f"""
SELECT copy || 'TXN' || strftime(o_orderdate, '%Y%m%d') || {pad(K, 12)} AS transaction_id,
  CASE WHEN {K} % 40 = 1 THEN '' WHEN {K} % 40 <> 0 THEN date_text END AS date,
  CASE WHEN {K} % 20 = 5 THEN '' WHEN {K} % 20 <> 0 THEN clock END AS time,
  CASE WHEN {K} % 20 NOT IN (0, 5) THEN date_text || ' ' || clock END AS datetime,
  CASE WHEN {K} % 97 <> 0 THEN 'CUST' || {pad('o_custkey', 9)} END AS customer_id,
  'ST' || {pad('l_suppkey', 6)} AS store_id,
  'Supplier#' || {pad('l_suppkey', 9)} || CASE WHEN l_linenumber % 5 = 0 THEN '{ZWSP}' ELSE '' END AS store_name,
  CASE WHEN l_tax <> 0 THEN 'EMP' || {pad(f'{K} % 500', 4)} END AS cashier_id,
  o_orderpriority AS payment_method,
  {m('total * 0.92::DOUBLE')} AS subtotal, {m('total * 0.08::DOUBLE')} AS tax_amount, total AS total_amount,
  {K} % 5 + 1 AS items_count,
  CASE WHEN {K} % 3 = 0 THEN 0 ELSE CAST(FLOOR(o_totalprice / 100) AS BIGINT) END AS loyalty_points_earned,
  CASE WHEN pct >= 30 THEN ' save10 ' WHEN pct > 0 THEN '' END AS promotion_code,
  CASE WHEN l_returnflag = 'R' THEN 'Returned ' END AS refund_reason,
  CASE WHEN l_returnflag = 'R' THEN 'Refunded' ELSE 'Completed' END AS status,
  CASE WHEN {K} % 89 = 0 AND l_linenumber = 1 THEN NULL
       WHEN {K} % 61 = 0 THEN 'INVALID' || {pad('l_partkey % 10000', 4)}
       ELSE 'PRD' || {pad('l_partkey', 9)} END AS product_id,
  'Part#' || {pad('l_partkey', 9)} || CASE WHEN l_linenumber % 4 = 0 THEN '{NBSP}' ELSE '' END AS product_name,
  'Category ' || CAST(l_partkey % 12 AS VARCHAR) AS category,
  qty AS quantity, price AS unit_price, pct AS discount_percent,
  CASE WHEN {K} % 31 = 0 THEN 0.0 ELSE {m('qty * price * (1 - pct / 100)')} END AS line_total,
  CAST(CAST(l_shipdate AS DATE) + CASE WHEN copy = 'DUP' AND {K} % 2 = 0 THEN 31 ELSE 0 END AS TIMESTAMP) AS data_created_modified
FROM till_lines
"""

C = "c_custkey"
CTES["customer_base"] = f"""
SELECT *,
  CASE WHEN {C} % 33 = 1 THEN '' WHEN {C} % 33 <> 0 THEN 'City' || CAST(c_nationkey AS VARCHAR) END AS city,
  CASE WHEN {C} % 11 = 0 THEN 'NATION_' || CAST((c_nationkey + 1) % 25 AS VARCHAR)
       WHEN {C} % 45 = 2 THEN '' ELSE n_name END AS state,
  {pad(f'c_nationkey * 1000 + {C} % 37', 5)} AS zip_code
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""
CTES["raw_customers"] = f"""
SELECT 'CUST' || {pad(C, 9)} AS customer_id,
  {pick(C, 'Anna', 'José', 'Zoë', 'Omar', 'Mei' + ZWSP, ' Li ')} AS first_name,
  CASE WHEN {C} % 50 <> 49 THEN 'Name' || CAST({C} AS VARCHAR) || CASE WHEN {C} % 7 = 0 THEN '{NBSP}' ELSE '' END END AS last_name,
  CASE WHEN {C} % 8 = 1 THEN 'User' || CAST({C} AS VARCHAR) || ' at Mail.com'
       WHEN {C} % 8 = 2 THEN 'user' || CAST({C} AS VARCHAR) || '@@mail.com'
       WHEN {C} % 8 = 3 THEN 'plain' || CAST({C} AS VARCHAR)
       WHEN {C} % 8 = 4 THEN '  U' || CAST({C} AS VARCHAR) || '@X.ORG '
       WHEN {C} % 16 = 5 THEN ''
       WHEN {C} % 24 = 6 THEN NULL
       ELSE 'user' || CAST({C} AS VARCHAR) || '@mail.com' END AS email,
  {phone(C)} AS phone,
  {address(C)} AS address,
  city, state, zip_code,
  CASE WHEN {C} % 40 = 4 THEN '' WHEN {C} % 40 = 5 THEN 'bad' WHEN {C} % 40 <> 3 THEN {day('1930-01-01', f'{C} * 13 % 27000')} END AS date_of_birth,
  {pick(C, 'M', 'female', 'Other', 'x', None, ' f ')} AS gender,
  CASE WHEN {C} % 52 = 7 THEN '' ELSE {day('1996-01-01', f'{C} * 7 % 2300')} END AS registration_date,
  CASE WHEN {C} % 3 = 0 THEN TRUE WHEN {C} % 3 = 1 THEN FALSE END AS loyalty_member,
  {pick(C, 'email', 'PHONE ', 'sms', 'fax')} AS preferred_contact,
  CASE WHEN {C} % 5 = 4 THEN c_mktsegment ELSE {pick(C, 'VIP', 'premium', 'Regular', 'BUDGET')} END AS customer_segment,
  c_acctbal AS total_lifetime_value, DATE '2001-12-01' AS modified_date
FROM customer_base
"""

P = "p_partkey"
CTES["part_base"] = f"""
SELECT *, p_name || ' ' || CAST({P} AS VARCHAR) AS clean_name,
  CASE WHEN {P} % 71 = 0 THEN NULL WHEN {P} % 103 = 1 THEN 0.5::DOUBLE WHEN {P} % 101 = 1 THEN {m('p_retailprice * 20')}
       ELSE {m('p_retailprice * (p_size % 13) * (p_size % 13) / 20')} END AS price,
  CASE WHEN p_size % 17 = 0 THEN 1.2::DOUBLE ELSE 0.4::DOUBLE + p_size / 100.0::DOUBLE END AS rate
FROM part
"""
CTES["raw_products"] = f"""
SELECT 'PRD' || {pad(P, 9)} AS product_id, clean_name || noise AS product_name,
  CASE WHEN {P} % 67 <> 0 THEN CASE WHEN {P} % 12 = 0 THEN '{NBSP}' ELSE '' END || p_type END AS category,
  SPLIT_PART(p_name, ' ', 2) AS subcategory,
  p_brand || CASE WHEN {P} % 9 = 0 THEN '{BAD}' ELSE '' END AS brand,
  price, CASE WHEN {P} % 73 <> 0 THEN {m('price * rate')} END AS cost,
  CASE WHEN {P} % 19 = 1 THEN '' WHEN {P} % 19 <> 0 THEN ' SKU-' || CAST({P} AS VARCHAR) END AS sku,
  CASE WHEN {P} % 29 = 1 THEN 0.005::DOUBLE WHEN {P} % 31 = 1 THEN 1200.0::DOUBLE WHEN {P} % 23 <> 0 THEN p_size / 2.0::DOUBLE END AS weight,
  CASE WHEN {P} % 37 <> 0 THEN CAST(p_size AS VARCHAR) || 'x' || CAST(p_size + 1 AS VARCHAR) || 'x2' END AS dimensions,
  CASE WHEN {P} % 41 <> 0 THEN {P} * 7 % 120 - 5 END AS stock_quantity,
  CASE WHEN {P} % 43 <> 0 THEN 'Vendor ' || CAST({P} % 50 AS VARCHAR) END AS supplier,
  CASE WHEN {P} % 47 <> 0 THEN {day('1998-01-01', f'{P} * 11 % 1600')} END AS launch_date,
  DATE '2001-12-01' AS modified_date
FROM part_base, LATERAL (SELECT UNNEST(CASE WHEN {P} % 10 = 3 THEN ['{ZWSP}'] WHEN {P} % 10 = 7 THEN ['', '{ZWSP}'] ELSE [''] END) AS noise)
"""

S = "s_suppkey"
CTES["supplier_base"] = f"""
SELECT *, CASE WHEN {S} % 27 <> 9 THEN {pick(S, 'New York', 'Chicago', 'Denver' + NBSP, 'Springfield', 'Austin')} END AS city,
  {pick(S, 'CA', 'TX', 'NY', 'OH', 'FL', 'WA')} AS state, '9' || {pad(f'{S} % 10000', 4)} AS zip_code
FROM supplier
"""
CTES["raw_stores"] = f"""
SELECT 'ST' || {pad(S, 6)} AS store_id, s_name || CASE WHEN {S} % 10 = 3 THEN '{ZWSP}' ELSE '' END AS store_name,
  {address(S)} AS address, city, state, zip_code,
  {phone(f'({S} * 3)')} AS phone,
  CASE WHEN {S} % 13 <> 0 THEN 'Manager ' || CAST({S} AS VARCHAR) END AS manager,
  {pick(S, 'Online', 'Flagship', 'main ', 'Express', 'Outlet', 'kiosk', 'Warehouse', 'pop-up')} AS store_type,
  CASE WHEN {S} % 21 <> 0 THEN {day('1975-01-01', f'{S} * 97 % 10000')} END AS opening_date,
  DATE '2001-12-01' AS modified_date
FROM supplier_base
"""

CTES["zip_lookup"] = f"""
SELECT {pad('n_nationkey * 1000 + i', 5)} AS zip_code, 'N' || {pad('n_nationkey', 2)} AS state_abrv, n_name AS state_name,
  'County ' || CAST(i AS VARCHAR) AS county_name, {pad('n_nationkey * 100 + i % 10', 5)} AS fips_code,
  CAST(n_nationkey + 20 AS DOUBLE) AS cent_lat, CAST(-(i + 60) AS DOUBLE) AS cent_long
FROM nation, LATERAL (SELECT UNNEST(generate_series(0, 29)) AS i)
"""

O = "o_orderkey"
CTES["nested_headers"] = f"""
SELECT {O} AS k, 'TXN' || strftime(o_orderdate, '%Y%m%d') || {pad(O, 12)} AS transaction_id, CAST(o_orderdate AS DATE) AS date,
  CASE WHEN {O} % 20 <> 0 THEN {pad(f'{O} % 15 + 8', 2)} || ':' || {pad(f'{O} % 60', 2)} || ':00' END AS time,
  CASE WHEN {O} % 20 <> 0 THEN o_orderdate END AS datetime,
  'CUST' || {pad('o_custkey', 9)} AS customer_id, 'ST' || {pad(f'{O} % 15', 6)} AS store_id,
  CASE WHEN {O} % 9 <> 0 THEN 'EMP' || {pad(f'{O} % 500', 4)} END AS cashier_id,
  CASE WHEN {O} % 13 <> 0 THEN o_orderpriority END AS payment_method,
  o_totalprice AS total_amount, {O} % 4 AS items_count,
  {pick(O, 'Completed', 'Completed', 'Completed', 'Failed', 'Refunded')} AS status
FROM orders
"""
CTES["nested_items"] = f"""
SELECT k, i, 'PRD' || {pad('part', 9)} AS product_id, 'Part#' || {pad('part', 9)} AS product_name,
  CASE WHEN part % 12 <> 0 THEN 'Category ' || CAST(part % 12 AS VARCHAR) END AS category,
  CASE WHEN k % 17 = 0 THEN -i ELSE i END AS quantity, {m('5.0::DOUBLE + part / 10.0::DOUBLE')} AS unit_price,
  0.0::DOUBLE AS discount_percent,
  {m('(CASE WHEN k % 17 = 0 THEN -i ELSE i END) * ' + m('5.0::DOUBLE + part / 10.0::DOUBLE'))} AS line_total
FROM (SELECT {O} AS k, i, ({O} * 7 + i * 13) % 1999 AS part FROM orders, LATERAL (SELECT UNNEST(generate_series(1, {O} % 4)) AS i))
"""

CTES["live_lines"] = f"""
SELECT CASE WHEN event_id % 11 = 0 THEN 'DUP' ELSE '' END || 'TXN' || strftime(ts, '%Y%m%d') || {pad('event_id', 12)} AS transaction_id,
  CAST(ts AS DATE) AS date, CASE WHEN event_id % 25 <> 0 THEN strftime(ts, '%H:%M:%S') END AS time,
  date_trunc('second', ts) AS datetime, 'CUST' || {pad('user_id', 9)} AS customer_id, 'ST-' || event_type AS store_id,
  CASE WHEN event_id % 13 <> 0 THEN 'card' END AS payment_method,
  CASE WHEN event_id % 37 <> 0 THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS total_amount,
  event_id % 5 + 1 AS items_count, 'Completed' AS status, 'PRD' || {pad('event_id % 50', 9)} AS product_id,
  event_id % 3 + 1 AS quantity, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS line_total, ts AS event_time
FROM events, LATERAL (SELECT UNNEST(CASE WHEN event_id % 17 = 0 THEN [1, 2] ELSE [1] END) AS send)
"""
