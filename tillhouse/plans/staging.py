"""Staging tables: typed, cleaned and flagged, one output row per input row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.context import DEFAULT, RunContext
from tillhouse.functions import buckets, dates, flags, measures, text


def canonical_names(df: DataFrame, key: str, name: str) -> DataFrame:
    """CLN2: per id, the spellings that need no cleaning."""
    clean = text.strip_non_printable(F.col(name))
    return df.where(text.is_clean(F.col(name))).select(key, clean.alias("clean_name")).distinct()


def store_name_of_lines(df: DataFrame) -> DataFrame:
    """CLN2 for till lines: one clean store name per store.

    Lines are keyed by (transaction, product), so a store with two clean
    spellings must not multiply them; the first in order is taken.  Unique store
    ids also let Spark drop this join from plans that do not use the name.
    """
    name = F.col("store_name")
    return df.where(text.is_clean(name)).groupBy("store_id").agg(F.min(text.strip_non_printable(name)).alias("clean_name"))


def zip_flags(customers: DataFrame, zips: DataFrame) -> DataFrame:
    """FLG7: invalid ZIP and ZIP/state mismatch with one lookup join.

    The ZIP table is collapsed to one row per ZIP (its state names as a set), so
    the left join cannot multiply customers.
    """
    known = zips.groupBy(F.col("zip_code").alias("zip_known")).agg(F.collect_set("state_name").alias("zip_states"))
    joined = customers.join(known, F.col("zip_code") == F.col("zip_known"), "left")
    match = F.coalesce(F.array_contains("zip_states", F.col("state")), F.lit(False))
    return joined.select(
        customers["*"],
        flags.flag(F.col("zip_known").isNull()).alias("invalid_zip_code_flag"),
        flags.flag(~match).alias("state_zip_mismatch_flag"),
    )


def stage_customers(raw: DataFrame, zips: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """Phone details are computed in the row: no self-join on the customer id."""
    c = F.col
    born, registered = dates.safe_date(c("date_of_birth")), dates.safe_date(c("registration_date"))
    phone = text.phone_extract(c("phone"))
    age = dates.years_between(born, ctx.today)
    first, last = text.strip_non_printable(c("first_name")), text.strip_non_printable(c("last_name"))
    return zip_flags(raw, zips).select(
        "customer_id",
        first.alias("first_name"), c("first_name").alias("raw_first_name"),
        last.alias("last_name"), c("last_name").alias("raw_last_name"),
        text.full_name(c("first_name"), c("last_name")).alias("full_name"),
        text.normalize_email(c("email")).alias("email"),
        c("phone").alias("raw_phone_number"),
        text.phone_country_code(c("phone")).alias("country_code"),
        phone.alias("phone"),
        text.phone_extension(c("phone")).alias("extension"),
        flags.invalid_phone_flag(phone).alias("invalid_phone_flag"),
        text.street_from_address(c("address")).alias("street_address"), c("address").alias("address_raw"),
        F.trim("city").alias("city"), F.trim("state").alias("state"), F.trim("zip_code").alias("zip_code"),
        "invalid_zip_code_flag", "state_zip_mismatch_flag",
        *[flags.address_mismatch(c("address"), c(p)).alias(f"address_{a}_mismatch_flag")
          for p, a in (("city", "city"), ("state", "state"), ("zip_code", "zip"))],
        *[flags.missing_flag(c(p)).alias(f"missing_{p}_flag") for p in ("city", "state", "zip_code", "email", "phone")],
        born.alias("date_of_birth"), age.alias("age"), buckets.age_group(age).alias("age_group"),
        text.map_enum(c("gender"), text.GENDERS).alias("gender"),
        registered.alias("registration_date"),
        F.datediff(ctx.today, registered).alias("days_since_registration"),
        buckets.tenure_by_months(dates.months_between_boundaries(registered, ctx.today)).alias("customer_tenure_category"),
        text.default_bool(c("loyalty_member")).alias("loyalty_member"),
        text.map_enum(c("preferred_contact"), text.CONTACTS).alias("preferred_contact"),
        text.map_enum(c("customer_segment"), text.SEGMENTS, "Unknown").alias("customer_segment"),
        "total_lifetime_value",
        flags.flag(c("total_lifetime_value") < 0).alias("negative_ltv_flag"),
        buckets.ltv_tier(c("total_lifetime_value")).alias("ltv_tier"),
        first.alias("first_name_clean"), last.alias("last_name_clean"),
        c("modified_date").alias("raw_loaded_at"), ctx.now.alias("staging_loaded_at"),
        flags.row_hash(
            c("customer_id"), c("first_name"), c("last_name"), c("email"), phone,
            c("city"), c("state"), c("zip_code"), flags.as_text(c("total_lifetime_value")),
        ).alias("_row_hash"),
        *[v.alias(k) for k, v in flags.audit_columns(ctx, "raw_customers").items()],
    )


def stage_products(raw: DataFrame, names: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """``names`` from :func:`canonical_names`; a product without a clean name drops out."""
    c = F.col
    launched = dates.safe_date(c("launch_date"))
    margin = measures.profit_margin_pct(c("price"), c("cost"))
    months = dates.months_between_boundaries(launched, ctx.today)
    clean = text.strip_non_printable
    return raw.join(names, "product_id").select(
        "product_id", c("clean_name").alias("product_name"), c("product_name").alias("product_name_raw"),
        clean(c("category")).alias("category"), clean(c("subcategory")).alias("subcategory"),
        clean(c("brand")).alias("brand"), F.trim("sku").alias("sku"),
        measures.money(c("price")).alias("selling_price"), c("price").alias("selling_price_raw"),
        measures.money(c("cost")).alias("cost_price"), c("cost").alias("cost_price_raw"),
        "weight", "dimensions",
        measures.negative_to_null(c("stock_quantity")).alias("stock_quantity"),
        c("stock_quantity").alias("stock_quantity_raw"),
        clean(c("supplier")).alias("supplier"),
        launched.alias("launch_date"),
        flags.future_flag(launched, ctx.today).alias("is_upcoming"),
        buckets.maturity_by_months(months).alias("product_maturity"),
        *[flags.missing_flag(c(p)).alias(f"missing_{p}_flag")
          for p in ("product_name", "category", "sku", "supplier", "dimensions", "launch_date")],
        *[v.alias(k) for k, v in flags.product_range_flags(c("price"), c("cost"), c("stock_quantity"), c("weight")).items()],
        buckets.weight_category_inclusive(c("weight")).alias("weight_category"),
        flags.future_flag(launched, ctx.today).alias("future_launch_date_flag"),
        margin.alias("profit_margin_pct"), buckets.margin_tier_inclusive(margin).alias("margin_tier"),
        buckets.price_tier(c("price")).alias("price_tier"), buckets.stock_status(c("stock_quantity")).alias("stock_status"),
        dates.days_since(launched, ctx.today).alias("days_since_launch"),
        c("modified_date").alias("raw_loaded_at"), ctx.now.alias("staging_loaded_at"),
        flags.row_hash(
            c("clean_name"), c("category"), c("subcategory"), c("brand"), flags.as_text(c("price")),
            flags.as_text(c("cost")), c("sku"), c("stock_quantity"), c("supplier"), c("launch_date"),
        ).alias("_row_hash"),
        *[v.alias(k) for k, v in flags.audit_columns(ctx, "raw_products").items()],
    )


def stage_stores(raw: DataFrame, names: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """``names`` from :func:`canonical_names`; a store without a clean name drops out."""
    c = F.col
    opened = dates.safe_date(c("opening_date"))
    days = dates.days_since(opened, ctx.today)
    clean = text.strip_non_printable
    return raw.join(names, "store_id").select(
        "store_id", c("clean_name").alias("store_name"), c("store_name").alias("store_name_raw"),
        text.street_from_address(c("address")).alias("store_address"), c("address").alias("store_address_raw"),
        clean(c("city")).alias("city"), clean(c("state")).alias("state"), F.trim("zip_code").alias("zip_code"),
        text.store_phone(c("phone")).alias("store_phone"), c("phone").alias("store_phone_raw"),
        F.trim("manager").alias("manager"), text.upper_trim(c("store_type")).alias("store_type"),
        opened.alias("opening_date"), days.alias("days_since_opening"),
        dates.rounded_years(days).alias("years_since_opening"),
        *[flags.address_mismatch(c("address"), c(p)).alias(f"address_{a}_mismatch_flag")
          for p, a in (("city", "city"), ("state", "state"), ("zip_code", "zip"))],
        *[flags.missing_flag(c(p)).alias(f"missing_{p}_flag")
          for p in ("city", "state", "zip_code", "phone", "manager", "store_name", "store_type", "opening_date")],
        flags.phone_too_short_flag(text.phone_digits(c("phone"))).alias("phone_too_short_flag"),
        flags.future_flag(opened, ctx.today).alias("future_opening_date_flag"),
        flags.very_old_flag(opened, ctx.today).alias("very_old_store_flag"),
        buckets.store_age_category(opened, F.datediff(ctx.today, opened), ctx.today).alias("store_age_category"),
        buckets.is_fully_operational(opened, c("phone"), c("manager"), ctx.today).alias("is_fully_operational"),
        c("modified_date").alias("raw_loaded_at"), ctx.now.alias("staging_loaded_at"),
        flags.row_hash(
            c("clean_name"), c("address"), c("city"), c("state"), c("zip_code"),
            c("phone"), c("manager"), c("store_type"), c("opening_date"),
        ).alias("_row_hash"),
        *[v.alias(k) for k, v in flags.audit_columns(ctx, "raw_stores").items()],
    )


def stage_transactions(
    raw: DataFrame, names: DataFrame, ctx: RunContext = DEFAULT, processed_at: Column | None = None, also: list[str] | None = None
) -> DataFrame:
    """``names``: clean store names; a store without one leaves the name NULL.  Columns named by ``also`` are passed on."""
    c = F.col
    day = dates.date_or_from_id(c("date"), c("transaction_id"))
    computed = measures.calculated_line_total(c("quantity"), c("unit_price"), c("discount_percent"))
    txn_clean = text.strip_dup_marker(c("transaction_id"))
    return raw.join(names, "store_id", "left").select(
        txn_clean.alias("transaction_id_clean"), c("transaction_id").alias("transaction_id_raw"),
        text.strip_dup_marker(F.concat("transaction_id", F.lit("-"), "product_id")).alias("transaction_product"),
        day.alias("transaction_date"),
        dates.time_or_midnight(c("time")).alias("transaction_time"),
        dates.compose_datetime(c("date"), c("time"), c("transaction_id")).alias("transaction_datetime"),
        *[v.alias(k) for k, v in dates.date_parts(day, c("time")).items()],
        "customer_id", "store_id", c("clean_name").alias("store_name"), "cashier_id",
        text.upper_trim(c("payment_method")).alias("payment_method"), text.upper_trim(c("status")).alias("payment_status"),
        measures.is_refund(c("status"), c("refund_reason")).alias("is_refund"),
        F.trim("refund_reason").alias("refund_reason"), text.upper_trim(c("promotion_code")).alias("promotion_code"),
        measures.has_promotion(c("promotion_code")).alias("has_promotion"),
        "subtotal", "tax_amount", "total_amount", "items_count", "loyalty_points_earned", "product_id",
        text.strip_non_printable(c("product_name")).alias("product_name"), F.trim("category").alias("category"),
        "quantity", measures.money(c("unit_price")).alias("unit_price"), "discount_percent",
        measures.discount_amount(c("quantity"), c("unit_price"), c("discount_percent")).alias("discount_amount"),
        computed.alias("calculated_line_total"), "line_total",
        flags.flag(c("transaction_id").isNull()).alias("missing_transaction_id_flag"),
        *[flags.missing_flag(c(p)).alias(f"missing_{p}_flag") for p in ("date", "time", "cashier_id", "payment_method")],
        flags.flag(c("customer_id").isNull()).alias("missing_customer_id_flag"),
        flags.flag(c("product_id").isNull()).alias("missing_product_id_flag"),
        *[v.alias(k) for k, v in flags.sale_range_flags(
            c("quantity"), c("unit_price"), c("line_total"), computed, c("total_amount"), c("status"), c("refund_reason")
        ).items()],
        c("data_created_modified").alias("raw_loaded_at"),
        (ctx.now if processed_at is None else processed_at).alias("staging_processed_at"),
        flags.row_hash(
            c("transaction_id"), c("product_id"), c("quantity"), flags.as_text(c("unit_price")),
            flags.as_text(c("line_total")), flags.as_text(c("total_amount")), c("status"),
        ).alias("_row_hash"),
        *[v.alias(k) for k, v in flags.audit_columns(ctx, "raw_transactions").items()], *(also or []),
    )
