"""Intermediate tables: admitted, de-duplicated and classified rows."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.context import DEFAULT, RunContext
from tillhouse.functions import buckets, flags, measures, text
from tillhouse.operators.dedup import latest_line

# The flags each admission rule needs to be down.
CUSTOMER_REQUIRED = ["missing_email_flag", "missing_city_flag", "missing_state_flag", "missing_zip_code_flag"]
CUSTOMER_COUNTED = [
    "missing_email_flag", "missing_phone_flag", "missing_city_flag",
    "missing_state_flag", "missing_zip_code_flag", "negative_ltv_flag",
]
PRODUCT_REQUIRED = [
    "missing_product_name_flag", "invalid_price_flag", "invalid_cost_flag",
    "cost_exceeds_price_flag", "missing_category_flag",
]
STORE_REQUIRED = [
    "missing_store_name_flag", "missing_city_flag", "missing_state_flag", "missing_zip_code_flag",
    "missing_phone_flag", "phone_too_short_flag", "missing_opening_date_flag", "future_opening_date_flag",
]
TRANSACTION_REQUIRED = [
    "missing_transaction_id_flag", "missing_date_flag", "missing_customer_id_flag", "missing_product_id_flag",
]
ADDRESS_MISMATCHES = ["address_city_mismatch_flag", "address_state_mismatch_flag", "address_zip_mismatch_flag"]


def _all_down(names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n) == 0 for n in names])


def admit_customers(df: DataFrame) -> DataFrame:
    """FIL1."""
    counted = reduce(add, [F.col(n) for n in CUSTOMER_COUNTED])
    return df.where(_all_down(CUSTOMER_REQUIRED) & (counted <= 2))


def admit_products(df: DataFrame) -> DataFrame:
    """FIL2."""
    return df.where(F.col("product_id").isNotNull() & _all_down(PRODUCT_REQUIRED))


def admit_stores(df: DataFrame) -> DataFrame:
    """FIL3."""
    return df.where(F.col("store_id").isNotNull() & _all_down(STORE_REQUIRED))


def admit_transactions(df: DataFrame) -> DataFrame:
    """FIL4, after :func:`latest_line`; a zero total is fine for refunds only."""
    zero_sale = (F.col("zero_total_amount_flag") == 1) & ~F.col("is_refund")
    return df.where(_all_down(TRANSACTION_REQUIRED) & ~zero_sale)


def customer_zip_lookup(df: DataFrame, zips: DataFrame) -> DataFrame:
    """JOI2: state, county and position by ZIP code."""
    lookup = zips.select(
        "zip_code", F.col("state_abrv").alias("state_code_from_zip"), F.col("state_name").alias("state_name_from_zip"),
        "county_name", "fips_code", F.col("cent_lat").alias("latitude"), F.col("cent_long").alias("longitude"),
    )
    return df.join(lookup, "zip_code", "left")


def refine_customers(staged: DataFrame, zips: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """Twelve flags are summed once; the tier reads that sum.

    The state is compared with the ZIP's state *name*, which is what customers
    carry; a two-letter code never equals a full name.
    """
    c = F.col
    admitted = customer_zip_lookup(
        admit_customers(staged).drop("invalid_zip_code_flag", "state_zip_mismatch_flag"), zips
    )
    known_zip = c("state_code_from_zip").isNotNull()
    wrong_state = (c("state") != c("state_code_from_zip")) & (c("state") != c("state_name_from_zip"))
    flagged = (
        admitted
        .withColumn("invalid_zip_code_flag", flags.flag(c("zip_code").isNotNull() & ~known_zip))
        .withColumn("state_zip_mismatch_flag", flags.flag(known_zip & wrong_state))
        .withColumn("phone_too_short_flag", flags.phone_too_short_flag(text.drop_first_non_digit(c("phone"))))
    )
    counted = [
        "missing_email_flag", "missing_phone_flag", "missing_city_flag", "missing_state_flag",
        "missing_zip_code_flag", "negative_ltv_flag", *ADDRESS_MISMATCHES,
        "invalid_zip_code_flag", "state_zip_mismatch_flag", "phone_too_short_flag",
    ]
    scored = flagged.withColumn("quality_issues_count", flags.quality_issues([c(n) for n in counted]))
    return scored.select(
        "customer_id", "first_name", "last_name", "full_name", "gender", "date_of_birth", "age",
        buckets.age_group(c("age")).alias("age_group"),
        "email", "phone",
        text.digits_after_x(c("phone")).alias("phone_extension"),
        text.phone_digits_only(c("phone")).alias("phone_digits_only"),
        "street_address", "city", "state", "zip_code",
        "state_code_from_zip", "state_name_from_zip", "county_name", "fips_code", "latitude", "longitude",
        "registration_date", "days_since_registration",
        buckets.tenure_by_days(c("days_since_registration")).alias("customer_tenure_category"),
        "customer_segment", c("total_lifetime_value").alias("lifetime_value"),
        buckets.ltv_category(c("total_lifetime_value")).alias("ltv_category"),
        *counted, "quality_issues_count", flags.quality_tier(c("quality_issues_count")).alias("quality_tier"),
        "staging_loaded_at", "staging_batch_id", F.lit(ctx.batch_id).alias("intermediate_batch_id"),
        "_source_system", ctx.now.alias("intermediate_loaded_at"), "_row_hash",
    )


def refine_products(staged: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    c = F.col
    core = [c("missing_sku_flag"), c("missing_supplier_flag")]
    extra = [c("missing_weight_flag"), c("missing_dimensions_flag"), c("missing_launch_date_flag")]
    return admit_products(staged).select(
        "product_id", "product_name", "category", "subcategory", "brand", "sku", "supplier",
        "selling_price", "cost_price", "profit_margin_pct", "price_tier",
        buckets.price_category(c("very_high_price_flag"), c("very_low_price_flag")).alias("price_category"),
        "stock_quantity", "stock_status",
        *[v.alias(k) for k, v in buckets.stock_flags(c("stock_quantity")).items()],
        "weight", "dimensions", buckets.weight_category(c("weight")).alias("weight_category"),
        "launch_date", "days_since_launch",
        buckets.maturity_by_days(c("days_since_launch")).alias("product_maturity"),
        (c("future_launch_date_flag") == 1).alias("is_upcoming"),
        buckets.margin_tier(c("profit_margin_pct")).alias("margin_tier"),
        flags.completeness(core, extra).alias("product_data_quality"),
        "staging_loaded_at", ctx.now.alias("intermediate_loaded_at"), "staging_batch_id",
        F.lit(ctx.batch_id).alias("intermediate_batch_id"), "_source_system", "_row_hash",
    )


def refine_stores(staged: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    c = F.col
    mismatches = [c(n) for n in ADDRESS_MISMATCHES]
    return admit_stores(staged).select(
        "store_id", "store_name", "store_type", "manager", "store_address", "city", "state", "zip_code",
        text.full_address(c("store_address"), c("city"), c("state"), c("zip_code")).alias("full_address"),
        flags.address_quality(*mismatches).alias("address_quality"),
        "store_phone", "opening_date", "days_since_opening", "years_since_opening", "store_age_category",
        buckets.store_maturity_tier(c("years_since_opening")).alias("store_maturity_tier"),
        "is_fully_operational", (c("very_old_store_flag") == 1).alias("is_legacy_store"),
        buckets.store_category(c("store_type")).alias("store_category"),
        buckets.region(c("state")).alias("region"), buckets.is_metro_area(c("city")).alias("is_metro_area"),
        flags.completeness(mismatches, [c("missing_manager_flag")]).alias("store_data_quality"),
        "staging_loaded_at", ctx.now.alias("intermediate_loaded_at"), "staging_batch_id",
        F.lit(ctx.batch_id).alias("intermediate_batch_id"), "_source_system", "_row_hash",
    )


def classify_transactions(
    admitted: DataFrame, ctx: RunContext = DEFAULT, processed_at: Column | None = None, also: list[str] | None = None
) -> DataFrame:
    """Measures, buckets and the line key, for rows already admitted; columns named by ``also`` are passed on."""
    c = F.col
    dow = c("transaction_day_of_week")
    corrections = ["negative_quantity_flag", "negative_amount_flag", "negative_line_total_flag", "zero_total_amount_flag"]
    gaps = ["missing_time_flag", "missing_cashier_id_flag"]
    return admitted.select(
        flags.surrogate_key(c("transaction_id_clean"), c("product_id")).alias("line_item_key"),
        c("transaction_id_clean").alias("transaction_id"),
        "product_id", "customer_id", "store_id", "store_name", "cashier_id",
        "transaction_date", "transaction_time", "transaction_datetime", "transaction_year", "transaction_month",
        "transaction_day", "transaction_day_of_week", "transaction_hour",
        buckets.is_weekend(dow).alias("is_weekend"), buckets.day_name(dow).alias("day_name"),
        buckets.time_of_day(c("transaction_hour")).alias("time_of_day"),
        "payment_method", "payment_status", "subtotal", "tax_amount", "total_amount", "items_count",
        "loyalty_points_earned", "product_name", "category", "quantity", "unit_price", "discount_percent",
        "discount_amount", "line_total",
        measures.line_total_clean(c("line_total"), c("quantity"), c("unit_price"), c("discount_percent"), c("is_refund"))
        .alias("line_total_clean"),
        measures.quantity_clean(c("quantity"), c("is_refund")).alias("quantity_clean"),
        "is_refund", "refund_reason", "has_promotion", "promotion_code",
        *[v.alias(k) for k, v in buckets.sale_flags(
            c("quantity"), c("line_total"), c("discount_percent"), c("loyalty_points_earned")).items()],
        buckets.transaction_type(c("is_refund"), c("has_promotion"), c("discount_percent")).alias("transaction_type"),
        flags.data_quality_status([c(n) for n in corrections], [c(n) for n in gaps], c("is_refund")).alias("data_quality_status"),
        c("negative_quantity_flag").alias("had_negative_quantity"), c("negative_amount_flag").alias("had_negative_amount"),
        c("zero_total_amount_flag").alias("had_zero_total"), c("missing_time_flag").alias("had_missing_time"),
        c("missing_cashier_id_flag").alias("had_missing_cashier"), c("high_unit_price_flag").alias("had_high_unit_price"),
        "raw_loaded_at", "staging_processed_at",
        (ctx.now if processed_at is None else processed_at).alias("intermediate_processed_at"),
        "staging_batch_id", F.lit(ctx.batch_id).alias("intermediate_batch_id"), "_source_system", *(also or []),
    )


def refine_transactions(staged: DataFrame, ctx: RunContext = DEFAULT, processed_at: Column | None = None) -> DataFrame:
    """WIN1 -> FIL4 -> classification."""
    return classify_transactions(admit_transactions(latest_line(staged)), ctx, processed_at)
