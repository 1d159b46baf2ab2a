"""The declared checks of every table.

Fixed values: accepted labels, ranges and thresholds.  A bare check is an error;
``.warn(n)`` warns above ``n`` failing rows.  Dates before 2020 only warn.
"""

from __future__ import annotations

from dataclasses import replace

from tillhouse.context import DEFAULT, RunContext
from tillhouse.functions import buckets
from tillhouse.operators.quality import (
    Check, accepted_range, accepted_values, expression, foreign_key, match_regex, not_empty_string, not_null, recency, unique, value_length,
)

EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
AGE_LABELS = ["Under 18", "18-24", "25-34", "35-44", "45-54", "55-64", "65+"]
TENURE_LABELS = ["New (< 3 months)", "Recent (3-12 months)", "Established (1-2 years)", "Loyal (2+ years)"]
LTV_LABELS = ["High Value", "Medium Value", "Low Value", "Very Low Value", "Negative"]
WEIGHT_LABELS = ["Unknown", *[label for _, _, label in buckets.WEIGHTS]]
MATURITY_LABELS = ["Unknown", *[label for _, _, label in buckets.MATURITY_BY_DAYS]]
MARGIN_LABELS = ["Unknown", *[label for _, _, label in buckets.MARGINS]]
STOCK_LABELS = ["In Stock", "Low Stock", "Out of Stock", "Discontinued"]
TYPE_LABELS = ["Refund", "Promotional Sale", "Promotion", "Deep Discount", "Discounted", "Regular Sale"]
STATUS_LABELS = ["COMPLETED", "PENDING", "FAILED", "REFUNDED", "CANCELLED"]
PAYMENTS = {
    "raw": ["Cash", "Credit Card", "Debit Card", "Digital Wallet", "Gift Card"],
    "staging": ["CASH", "CREDIT CARD", "DEBIT CARD", "MOBILE PAYMENT", "GIFT CARD", "CHECK", "OTHER"],
    "intermediate": ["CASH", "CREDIT CARD", "DEBIT CARD", "MOBILE PAYMENT", "GIFT CARD", "CHECK"],
}
GENDER_LABELS = ["M", "F", "Male", "Female", "Other", "Non-binary", "Prefer not to say"]
DAY_PART_LABELS = [*[label for _, _, label in buckets.DAY_PARTS], "Unknown"]
STORE_AGE_LABELS = ["Brand New (< 1 year)", "New (1-3 years)", "Established (3-5 years)", "Mature (5-10 years)", "Legacy (10+ years)"]
STORE_MATURITY_LABELS = ["Unknown", *[label for _, _, label in buckets.STORE_MATURITY]]
TODAY = "date'{as_of}'"
NOW = "timestamp_ntz'{now}'"


def _not_null(*columns: str) -> list[Check]:
    return [not_null(c) for c in columns]


def _not_null_warn(above: int, *columns: str) -> list[Check]:
    return [not_null(c).warn(above) for c in columns]


def _flags(*columns: str) -> list[Check]:
    return [check for c in columns for check in (not_null(c), accepted_values(c, [0, 1]))]


def _booleans(*columns: str) -> list[Check]:
    return [check for c in columns for check in (not_null(c), accepted_values(c, [True, False]))]


def _not_future(*columns: str) -> list[Check]:
    return [expression(c, f"<= {TODAY}", f"{c} is not null") for c in columns]


def _since(year: int, column: str, above: int) -> Check:
    return expression(column, f">= date'{year}-01-01'", f"{column} is not null").warn(above)


def _loaded(*columns: str) -> list[Check]:
    return [expression(c, f"<= {NOW}") for c in columns]


def _id(column: str) -> list[Check]:
    return [unique(column), not_null(column), not_empty_string(column)]


def _source() -> list[Check]:
    return [not_null("_source_system"), accepted_values("_source_system", ["RETAIL_S3"]).warn()]


def _place(above: int) -> list[Check]:
    return [
        *[not_empty_string(c) for c in ("city", "state", "zip_code")],
        value_length("state", 2, 2).warn(above), value_length("zip_code", 5, 10).warn(above),
    ]


def _raw_transactions() -> list[Check]:
    required = [
        "transaction_id", "date", "time", "datetime", "customer_id", "store_id", "store_name", "payment_method", "subtotal",
        "tax_amount", "total_amount", "items_count", "loyalty_points_earned", "status", "product_id", "product_name", "category",
        "quantity", "unit_price", "discount_percent", "line_total",
    ]
    ranges = {
        "subtotal": (-1000000.0, 1000000.0), "tax_amount": (0.0, None), "total_amount": (-1000000.0, 1000000.0), "items_count": (1, 1000),
        "loyalty_points_earned": (0, None), "quantity": (-1000, 1000), "unit_price": (0.0, 100000.0), "discount_percent": (0.0, 100.0),
        "line_total": (-100000.0, 100000.0),
    }
    parents = {"customer_id": "customers", "store_id": "stores", "product_id": "products"}
    return [
        *_not_null_warn(0, *required),
        expression("try_cast(date as date)", ">= date'2020-01-01'").warn(),
        accepted_values("payment_method", PAYMENTS["raw"]).warn(), accepted_values("status", ["Failed", "Completed", "Refunded"]).warn(),
        *[accepted_range(c, *r).warn() for c, r in ranges.items()],
        *[foreign_key(c, f"raw_{t}", c).warn() for c, t in parents.items()],
    ]


def _raw_customers() -> list[Check]:
    required = [
        "customer_id", "first_name", "last_name", "email", "phone", "address", "city", "state", "zip_code", "date_of_birth", "gender",
        "registration_date", "loyalty_member", "preferred_contact", "customer_segment", "total_lifetime_value",
    ]
    return [
        unique("customer_id").warn(), unique("email").warn(), *_not_null_warn(0, *required), not_empty_string("email"),
        expression("try_cast(date_of_birth as date)", f"<= add_months({TODAY}, -216)").warn(),
        expression("try_cast(registration_date as date)", f"<= {TODAY}"),
        accepted_values("gender", ["Male", "Female", "Other"]).warn(), accepted_values("loyalty_member", [True, False]).warn(),
        accepted_values("preferred_contact", ["Phone", "SMS", "Email"]).warn(),
        accepted_values("customer_segment", ["Budget", "Premium", "Regular", "VIP"]).warn(), accepted_range("total_lifetime_value", 0).warn(),
    ]


def _raw_products() -> list[Check]:
    required = [
        "product_id", "product_name", "category", "subcategory", "brand", "price", "cost", "sku", "weight", "dimensions",
        "stock_quantity", "supplier", "launch_date",
    ]
    return [
        unique("product_id").warn(), unique("sku").warn(), *_not_null_warn(0, *required),
        *[accepted_range(c, 0).warn() for c in ("price", "cost", "weight", "stock_quantity")],
    ]


def _raw_stores() -> list[Check]:
    required = ["store_id", "store_name", "address", "city", "state", "zip_code", "phone", "manager", "store_type", "opening_date"]
    return [
        unique("store_id").warn(), unique("store_name"), unique("address").warn(), unique("phone").warn(), *_not_null_warn(0, *required),
        accepted_values("store_type", ["Online", "Flagship", "Mall", "Express", "Outlet"]).warn(),
        expression("try_cast(opening_date as date)", f"<= {TODAY}"),
    ]


def _stg_transactions() -> list[Check]:
    flags = [
        "missing_transaction_id_flag", "missing_date_flag", "missing_time_flag", "missing_customer_id_flag", "missing_product_id_flag",
        "missing_cashier_id_flag", "negative_quantity_flag", "negative_amount_flag", "negative_line_total_flag", "zero_total_amount_flag",
        "zero_quantity_flag", "high_unit_price_flag", "high_total_amount_flag",
    ]
    parents = {"customer_id": "customers", "store_id": "stores", "product_id": "products"}
    return [
        unique("transaction_id_clean", "product_id").warn(), recency("staging_processed_at", 2).warn(),
        *_not_null("transaction_id_clean", "transaction_id_raw", "transaction_date", "transaction_year", "transaction_month", "transaction_day",
                   "product_id", "quantity", "unit_price", "raw_loaded_at", "staging_processed_at", "staging_batch_id", "_row_hash", "_source_table"),
        *_not_null_warn(0, "transaction_product", "transaction_time", "transaction_datetime", "store_name", "subtotal", "tax_amount",
                        "product_name", "category", "line_total", "missing_payment_method_flag"),
        *_not_null_warn(100, "customer_id", "store_id", "total_amount"), *_not_null_warn(200, "cashier_id"),
        not_empty_string("transaction_id_clean"), *_not_future("transaction_date"), _since(2020, "transaction_date", 100),
        accepted_range("transaction_year", 2020, 2030), accepted_range("transaction_month", 1, 12), accepted_range("transaction_day", 1, 31),
        accepted_range("transaction_day_of_week", 0, 6), accepted_range("transaction_hour", 0, 23),
        *[foreign_key(c, f"stg_{t}", c).warn() for c, t in parents.items()],
        accepted_values("payment_method", PAYMENTS["staging"]).warn(500), accepted_values("payment_status", STATUS_LABELS).warn(200),
        *_booleans("is_refund", "has_promotion"), expression("refund_reason", "is not null", "is_refund").warn(100),
        accepted_range("items_count", 0, 1000).warn(), accepted_range("loyalty_points_earned", 0, 100000).warn(),
        accepted_range("discount_percent", 0, 100).warn(200), accepted_range("discount_amount", 0, 1000000).warn(),
        *_flags(*flags), accepted_values("missing_payment_method_flag", [0, 1]),
        expression("missing_transaction_id_flag", "= 0"), expression("missing_product_id_flag", "= 0"),
        *_loaded("staging_processed_at"), *_source(), accepted_values("_source_table", ["raw_transactions"]),
    ]


def _people(tenure_and_flags: list[Check]) -> list[Check]:
    """Checks the two customer layers share."""
    return [
        *_id("customer_id"), *_not_null_warn(100, "first_name", "last_name"), not_empty_string("first_name").warn(),
        *_not_null_warn(0, "full_name", "date_of_birth", "age", "age_group", "street_address", "registration_date", "days_since_registration", "customer_segment"),
        accepted_values("gender", GENDER_LABELS).warn(), *_not_future("date_of_birth", "registration_date"),
        _since(1920, "date_of_birth", 0), _since(2020, "registration_date", 50),
        accepted_range("age", 0, 120), replace(accepted_range("age", 18, 100).warn(100), name="adult_age(age)"),
        accepted_values("age_group", AGE_LABELS), not_empty_string("email"), match_regex("email", EMAIL).warn(50), *_not_null_warn(200, "phone"),
        *_place(50), accepted_range("days_since_registration", 0, 10000).warn(), accepted_values("customer_tenure_category", TENURE_LABELS).warn(),
        *_flags("invalid_zip_code_flag", "state_zip_mismatch_flag"),
        expression("invalid_zip_code_flag", "= 0").warn(200), expression("state_zip_mismatch_flag", "= 0").warn(100), *_source(),
        *tenure_and_flags,
    ]


def _stg_customers() -> list[Check]:
    return _people([
        recency("staging_loaded_at", 2).warn(), *_not_null_warn(0, "city", "state", "zip_code", "ltv_tier", "staging_batch_id"),
        accepted_values("ltv_tier", LTV_LABELS).warn(),
        *_flags("missing_email_flag", "missing_city_flag", "missing_state_flag", "missing_zip_code_flag"),
        *_not_null("raw_loaded_at", "staging_loaded_at"), *_loaded("staging_loaded_at"),
    ])


def _intmd_customers() -> list[Check]:
    zeros = ["missing_email_flag", "missing_city_flag", "missing_state_flag", "missing_zip_code_flag"]
    return _people([
        recency("intermediate_loaded_at", 2).warn(), *_not_null_warn(0, "email", "zip_code", "lifetime_value", "ltv_category", "intermediate_batch_id"),
        *_not_null("city", "state", "quality_issues_count", "quality_tier", "staging_loaded_at", "intermediate_loaded_at", *zeros),
        accepted_values("phone_too_short_flag", [0, 1]), expression("phone_too_short_flag", "= 0").warn(100),
        value_length("state_code_from_zip", 2, 2).warn(), value_length("fips_code", 5, 5).warn(),
        accepted_range("latitude", 24, 50).warn(100), accepted_range("longitude", -125, -65).warn(100),
        accepted_range("lifetime_value", -10000, 1000000).warn(100), accepted_values("ltv_category", LTV_LABELS).warn(),
        *[accepted_values(z, [0]) for z in zeros], accepted_range("quality_issues_count", 0, 20).warn(),
        expression("quality_issues_count", "<= 2").warn(100), accepted_values("quality_tier", ["CLEAN", "ACCEPTABLE", "POOR"]),
        expression("quality_tier", "in ('CLEAN', 'ACCEPTABLE')").warn(100), *_loaded("intermediate_loaded_at"),
    ])


def _goods(layer: list[Check]) -> list[Check]:
    """Checks the two product layers share."""
    prices = [
        check for c in ("selling_price", "cost_price")
        for check in (not_null(c), expression(c, "> 0"), accepted_range(c, 0.01, 100000).warn(50))
    ]
    return [
        *_id("product_id"), *_not_null("product_name", "category", "staging_loaded_at"), not_empty_string("product_name"), not_empty_string("category"),
        *_not_null_warn(100, "subcategory", "sku"), *_not_null_warn(200, "brand", "supplier"), unique("sku").warn(50), *prices,
        *_not_null_warn(0, "profit_margin_pct", "price_tier", "stock_quantity", "stock_status", "weight_category", "product_maturity", "margin_tier"),
        accepted_range("profit_margin_pct", -100, 1000).warn(100), expression("profit_margin_pct", ">= 0").warn(200),
        accepted_range("stock_quantity", 0, 1000000).warn(100), accepted_values("stock_status", STOCK_LABELS).warn(100),
        accepted_range("weight", 0, 10000).warn(50), accepted_values("weight_category", WEIGHT_LABELS).warn(),
        expression("launch_date", f"<= add_months({TODAY}, 12)", "launch_date is not null").warn(50), _since(2020, "launch_date", 100),
        accepted_range("days_since_launch", -365, 10000).warn(50), accepted_values("product_maturity", MATURITY_LABELS).warn(),
        accepted_values("margin_tier", MARGIN_LABELS).warn(), *_source(), *layer,
    ]


def _stg_products() -> list[Check]:
    return _goods([
        recency("staging_loaded_at", 2).warn(), accepted_values("price_tier", ["Premium", "Mid-Range", "Budget", "Economy", "Invalid"]),
        *[check for c in ("zero_stock_quantity_flag", "is_low_stock", "is_upcoming") for check in (not_null(c).warn(), accepted_values(c, [0, 1]))],
        *_not_null("raw_loaded_at", "staging_batch_id"), *_loaded("staging_loaded_at"),
    ])


def _intmd_products() -> list[Check]:
    return _goods([
        recency("intermediate_loaded_at", 2).warn(), accepted_values("price_tier", ["Budget", "Mid-Range", "Premium", "Luxury"]).warn(100),
        accepted_values("price_category", ["LUXURY", "CLEARANCE", "STANDARD"]), not_null("price_category").warn(),
        *_booleans("is_available", "is_out_of_stock", "is_low_stock", "is_upcoming"),
        not_null("product_data_quality"), accepted_values("product_data_quality", ["COMPLETE", "GOOD", "BASIC"]),
        *_not_null("intermediate_loaded_at", "intermediate_batch_id"), not_null("staging_batch_id").warn(), *_loaded("intermediate_loaded_at"),
    ])


def _shops(layer: list[Check]) -> list[Check]:
    """Checks the two store layers share."""
    return [
        *_id("store_id"), *_not_null("store_name", "city", "state", "zip_code", "store_phone", "opening_date", "staging_loaded_at"),
        not_empty_string("store_name"), not_empty_string("store_phone"), *_not_null_warn(5, "manager"),
        *_not_null_warn(0, "store_address", "days_since_opening", "years_since_opening", "store_age_category", "store_type"),
        *_place(5), *_not_future("opening_date"), _since(1950, "opening_date", 3),
        accepted_range("days_since_opening", 0, 50000).warn(), accepted_range("years_since_opening", 0, 100).warn(3),
        accepted_values("store_age_category", STORE_AGE_LABELS).warn(), *_booleans("is_fully_operational"),
        expression("is_fully_operational", "= true").warn(3), *_source(), *layer,
    ]


def _stg_stores() -> list[Check]:
    return _shops([
        recency("staging_loaded_at", 2).warn(), accepted_values("store_type", ["Flagship", "Outlet", "Mall", "Online"]).warn(),
        *_not_null("raw_loaded_at", "staging_batch_id"), *_loaded("staging_loaded_at"),
    ])


def _intmd_stores() -> list[Check]:
    kinds = ["FLAGSHIP", "MAIN", "OUTLET", "CLEARANCE", "KIOSK", "POP-UP", "WAREHOUSE", "STANDARD", "EXPRESS", "SUPERSTORE"]
    return _shops([
        recency("intermediate_loaded_at", 2).warn(), accepted_values("store_type", kinds).warn(10),
        not_null("full_address").warn(), not_empty_string("full_address").warn(),
        not_null("address_quality"), accepted_values("address_quality", ["VALID", "INCONSISTENT"]), expression("address_quality", "= 'VALID'").warn(5),
        not_null("store_maturity_tier").warn(), accepted_values("store_maturity_tier", STORE_MATURITY_LABELS).warn(),
        *_booleans("is_legacy_store", "is_metro_area"), not_null("store_category").warn(),
        accepted_values("store_category", ["Flagship", "Outlet", "Temporary", "Warehouse", "Standard"]).warn(),
        not_null("region"), accepted_values("region", ["West", "South", "Northeast", "Midwest", "Other"]),
        not_null("store_data_quality"), accepted_values("store_data_quality", ["COMPLETE", "GOOD", "BASIC"]),
        *_not_null("intermediate_loaded_at", "intermediate_batch_id"), not_null("staging_batch_id").warn(), *_loaded("intermediate_loaded_at"),
    ])


def _intmd_transactions() -> list[Check]:
    parents = {"product_id": "products", "customer_id": "customers", "store_id": "stores"}
    return [
        unique("transaction_id", "product_id"), unique("line_item_key"),
        *_not_null("line_item_key", "transaction_id", "product_id", "customer_id", "transaction_date", "transaction_year", "transaction_month",
                   "quantity_clean", "unit_price", "line_total_clean", "data_quality_status", "raw_loaded_at", "staging_processed_at",
                   "intermediate_processed_at"),
        *_not_null_warn(0, "store_id", "payment_method", "transaction_type"), not_empty_string("transaction_id"),
        *[foreign_key(c, f"intmd_{t}", c).warn() for c, t in parents.items()],
        *_not_future("transaction_date"), _since(2020, "transaction_date", 0), accepted_range("transaction_year", 2020, 2030),
        accepted_range("transaction_month", 1, 12), accepted_range("transaction_day_of_week", 0, 6), accepted_values("is_weekend", [True, False]),
        accepted_values("day_name", buckets.DAY_NAMES), accepted_values("time_of_day", DAY_PART_LABELS).warn(),
        accepted_values("payment_method", PAYMENTS["intermediate"]).warn(), accepted_values("payment_status", STATUS_LABELS).warn(),
        expression("quantity_clean", ">= 0", "not is_refund"), expression("unit_price", ">= 0"), accepted_range("discount_percent", 0, 100).warn(),
        *_booleans("is_refund", "has_promotion", "has_discount", "is_bulk_purchase", "is_high_value_item"),
        accepted_values("transaction_type", TYPE_LABELS).warn(), accepted_values("data_quality_status", ["CLEAN", "CORRECTED", "INCOMPLETE"]).warn(),
        *_loaded("intermediate_processed_at"), *_source(),
    ]


def _fact_sales() -> list[Check]:
    return [
        unique("transaction_id", "product_key"), unique("sales_key"), *_not_null("sales_key", "transaction_id", "is_refund", "line_total", "line_profit"),
        accepted_values("is_refund", [True, False]), accepted_values("transaction_type", TYPE_LABELS).warn(),
        accepted_values("data_quality_status", ["CLEAN", "CORRECTED", "INCOMPLETE"]).warn(),
    ]


def _dim_customers() -> list[Check]:
    return [
        unique("customer_key"), not_null("customer_key"), unique("customer_id"), not_null("customer_id"), accepted_range("age", 18, 120).warn(),
        accepted_values("age_group", AGE_LABELS).warn(), accepted_values("gender", ["Male", "Female", "Other", "Prefer not to say"]).warn(),
        accepted_values("customer_tenure_category", TENURE_LABELS).warn(), accepted_values("ltv_category", LTV_LABELS).warn(),
        accepted_values("quality_tier", ["CLEAN", "ACCEPTABLE", "POOR"]).warn(),
    ]


def _dim_products() -> list[Check]:
    known_cost = "cost_price is not null"
    return [
        unique("product_key"), not_null("product_key"), unique("product_id"), not_null("product_id"), not_null("selling_price").warn(),
        expression("selling_price", ">= 0"), expression("cost_price", ">= 0", known_cost), expression("cost_price", "<= selling_price", known_cost).warn(),
        accepted_range("profit_margin_pct", -100, 100).warn(), accepted_values("price_category", ["LUXURY", "CLEARANCE", "STANDARD"]).warn(),
        accepted_values("weight_category", WEIGHT_LABELS).warn(), accepted_values("product_maturity", MATURITY_LABELS).warn(),
    ]


def _dim_stores() -> list[Check]:
    return [unique("store_key"), not_null("store_key"), unique("store_id"), not_null("store_id")]


def _dim_date() -> list[Check]:
    return [unique("date_key"), not_null("date_key"), unique("date_actual"), not_null("date_actual")]


def _revenue_performance() -> list[Check]:
    return [
        unique("date"),
        *_not_null("date", "year", "quarter", "month", "month_name", "day_name", "day_type", "revenue", "cost", "profit", "transactions",
                   "customers", "units_sold", "avg_order_value", "revenue_7day_avg", "revenue_30day_avg", "revenue_mtd", "revenue_ytd",
                   "is_today", "is_last_7_days", "is_last_30_days"),
        *[accepted_values(c, [True, False]) for c in ("is_today", "is_last_7_days", "is_last_30_days")],
        accepted_range("quarter", 1, 4), accepted_range("month", 1, 12), accepted_values("day_type", ["Weekend", "Weekday"]),
        expression("revenue", ">= 0"), expression("cost", ">= 0"), accepted_range("profit_margin_pct", 0, 100).warn(),
        *[expression(c, "> 0") for c in ("transactions", "customers", "units_sold")], expression("revenue_ytd", ">= revenue_mtd"),
    ]


def _store_performance() -> list[Check]:
    return [
        unique("store_id"),
        *_not_null("store_id", "store_name", "city", "state", "total_revenue", "total_profit", "profit_margin_pct", "total_transactions",
                   "total_customers", "total_units_sold", "avg_daily_revenue", "avg_daily_transactions", "revenue_per_customer",
                   "transactions_per_customer", "revenue_rank", "profit_rank", "rank_in_region", "performance_tier", "margin_status",
                   "first_sale_date", "last_sale_date", "days_with_sales", "days_since_last_sale"),
        accepted_range("profit_margin_pct", 0, 100).warn(), accepted_range("revenue_rank", 1), accepted_range("profit_rank", 1),
        *[expression(c, "> 0") for c in ("total_transactions", "total_customers", "total_units_sold", "days_with_sales")],
        accepted_values("performance_tier", ["Top 3", "Top 25%", "Above Average", "Below Average", "Bottom 25%"]),
        accepted_values("margin_status", ["Excellent Margin", "Good Margin", "Fair Margin", "Low Margin"]),
    ]


def _products_performance() -> list[Check]:
    positive = ["list_price", "cost_price", "total_units_sold", "total_transactions", "unique_customers", "revenue_rank", "profit_rank",
                "units_rank", "rank_in_category", "days_with_sales"]
    return [
        unique("product_id"), *_not_null_warn(0, "total_revenue", "profit_margin_pct"),
        *_not_null("product_id", "product_name", "category", "list_price", "cost_price", "avg_actual_price", "total_profit", "total_units_sold",
                   "total_transactions", "unique_customers", "avg_daily_revenue", "avg_daily_units", "revenue_per_customer", "units_per_customer",
                   "revenue_rank", "profit_rank", "units_rank", "rank_in_category", "performance_tier", "abc_class", "profit_status",
                   "sales_velocity", "first_sale_date", "last_sale_date", "days_with_sales", "days_since_last_sale"),
        *[expression(c, "> 0") for c in positive], expression("days_since_last_sale", ">= 0"), accepted_range("profit_margin_pct", -100, 100).warn(),
        accepted_values("performance_tier", ["Top 10", "Top 20%", "Top 50%", "Bottom 50%"]),
        accepted_values("abc_class", ["A - Top Products", "B - Medium Products", "C - Low Products"]),
        accepted_values("profit_status", ["High Margin Winner", "Volume Driver", "Profitable", "Loss Maker"]),
        accepted_values("sales_velocity", ["Hot Seller", "Active", "Slow Moving", "Dormant"]),
    ]


def _customer_metrics() -> list[Check]:
    buyers = ["One-Time Buyer", "Occasional Buyer (2 purchases)", "Regular Buyer (3-5 purchases)", "Frequent Buyer (6-10 purchases)", "VIP Buyer (10+ purchases)"]
    return [
        unique("customer_id"),
        *_not_null("customer_id", "full_name", "total_purchases", "days_purchased", "months_active", "lifetime_revenue", "avg_purchase_value",
                   "first_purchase_date", "last_purchase_date", "customer_lifespan_days", "days_since_last_purchase", "purchases_per_month",
                   "buyer_type", "activity_status", "value_tier", "purchase_pattern"),
        *[expression(c, "> 0") for c in ("total_purchases", "days_purchased", "months_active")],
        expression("customer_lifespan_days", ">= 0"), expression("days_since_last_purchase", ">= 0"), accepted_values("buyer_type", buyers),
        accepted_values("activity_status", ["Active (Last 30 days)", "Recent (Last 60 days)", "At Risk (60-90 days)", "Inactive (90+ days)"]),
        accepted_values("value_tier", ["High Value ($1000+)", "Medium Value ($500-$1000)", "Low Value ($100-$500)", "Very Low Value (<$100)"]),
        accepted_values("purchase_pattern", ["Single Purchase", "Same Day Purchases", "Weekly Buyer", "Monthly Buyer", "Irregular Buyer"]),
    ]


SUITES = {
    "raw_transactions": _raw_transactions, "raw_customers": _raw_customers, "raw_products": _raw_products, "raw_stores": _raw_stores,
    "stg_transactions": _stg_transactions, "stg_customers": _stg_customers, "stg_products": _stg_products, "stg_stores": _stg_stores,
    "intmd_transactions": _intmd_transactions, "intmd_customers": _intmd_customers, "intmd_products": _intmd_products, "intmd_stores": _intmd_stores,
    "fact_sales": _fact_sales, "dim_customers": _dim_customers, "dim_products": _dim_products, "dim_stores": _dim_stores, "dim_date": _dim_date,
    "revenue_performance": _revenue_performance, "store_performance": _store_performance, "products_performance": _products_performance,
    "customer_metrics": _customer_metrics,
}


def suite(table: str, ctx: RunContext = DEFAULT) -> list[Check]:
    """The checks of a table with the run's dates filled in, each name once."""
    values = {"{as_of}": ctx.as_of.isoformat(), "{now}": ctx.run_ts.isoformat(sep=" ")}
    out: dict[str, Check] = {}
    for check in SUITES[table]():
        name, fails = check.name, check.fails
        for mark, value in values.items():
            name, fails = name.replace(mark, value), fails.replace(mark, value)
        out.setdefault(name, replace(check, name=name, fails=fails))
    return list(out.values())


def parent_tables(table: str, ctx: RunContext = DEFAULT) -> list[str]:
    """Tables the foreign keys of a suite point to."""
    return list(dict.fromkeys(c.parent for c in suite(table, ctx) if c.parent))
