"""Declared schemas: reads never infer, drift shows as a mismatch."""

from __future__ import annotations

from pyspark.sql import types as T

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

RAW_TRANSACTIONS = (
    "transaction_id string, date string, time string, datetime string, customer_id string, store_id string, "
    "store_name string, cashier_id string, payment_method string, subtotal double, tax_amount double, "
    "total_amount double, items_count bigint, loyalty_points_earned bigint, promotion_code string, "
    "refund_reason string, status string, product_id string, product_name string, category string, "
    "quantity bigint, unit_price double, discount_percent double, line_total double, "
    "data_created_modified timestamp_ntz"
)

ITEM = (
    "product_id string, product_name string, category string, quantity bigint, unit_price double, "
    "discount_percent double, line_total double"
)

ZIP_LOOKUP = (
    "zip_code string, state_abrv string, state_name string, county_name string, fips_code string, "
    "cent_lat double, cent_long double"
)

# A live message arrives as text; every field is parsed as string first and then
# coerced, so that one bad number does not void the whole message.
LIVE_DATES = ["date"]
LIVE_TIMESTAMPS = ["datetime"]
LIVE_NUMBERS = {
    "subtotal": "double", "tax_amount": "double", "total_amount": "double", "items_count": "bigint",
    "loyalty_points_earned": "bigint", "quantity": "bigint", "unit_price": "double",
    "discount_percent": "double", "line_total": "double",
}
LIVE_STRINGS = [
    "transaction_id", "time", "customer_id", "store_id", "store_name", "cashier_id", "payment_method",
    "status", "product_id", "product_name", "category", "promotion_code", "refund_reason",
]


def struct(ddl: str) -> T.StructType:
    """DDL text as a StructType."""
    return T.StructType.fromDDL(ddl)


def live_message() -> T.StructType:
    """All-string schema of a live JSON message."""
    names = [*LIVE_STRINGS, *LIVE_DATES, *LIVE_TIMESTAMPS, *LIVE_NUMBERS]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])
