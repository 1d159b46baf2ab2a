"""CLN*, MEA*, BKT*, FLG*, KEY*, AUD*: one query per rule, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillhouse.context import DEFAULT as CTX
from tillhouse.functions import buckets, dates, flags, measures, text
from tillhouse.operators.streams import coerce_types, parse_messages
from tillhouse.plans import staging
from tillhouse.plans.inputs import Warehouse
from tillhouse.queries.registry import query
from tillhouse.sources import standin
from tillhouse.sources.files import table

c = F.col


def _customers(spark, sf):
    return standin.raw_customers(spark, sf)


def _products(spark, sf):
    return standin.raw_products(spark, sf)


def _stores(spark, sf):
    return standin.raw_stores(spark, sf)


def _lines(spark, sf):
    return standin.raw_transactions(spark, sf)


@query("cln1_strip_non_printable")
def cln1(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.strip_non_printable(c("text")).alias("clean_text"))


@query("cln2_canonical_name")
def cln2(spark, sf):
    names = staging.canonical_names(_products(spark, sf), "product_id", "product_name")
    return _products(spark, sf).join(names, "product_id").select("product_id", "product_name", "clean_name")


@query("cln3_full_name")
def cln3(spark, sf):
    return _customers(spark, sf).select("customer_id", text.full_name(c("first_name"), c("last_name")).alias("full_name"))


@query("cln4_normalize_email")
def cln4(spark, sf):
    return _customers(spark, sf).select("customer_id", text.normalize_email(c("email")).alias("email"))


@query("cln4_email_in_documents")
def cln4_documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.normalize_email(c("text")).alias("email"))


@query("cln5_phone_country_code")
def cln5(spark, sf):
    return _customers(spark, sf).select("customer_id", text.phone_country_code(c("phone")).alias("country_code"))


@query("cln6_phone_extension")
def cln6(spark, sf):
    return _customers(spark, sf).select("customer_id", text.phone_extension(c("phone")).alias("extension"))


@query("cln7_phone_extract")
def cln7(spark, sf):
    return _customers(spark, sf).select("customer_id", text.phone_extract(c("phone")).alias("extracted_phone"))


@query("cln7_phone_in_documents")
def cln7_documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.phone_extract(c("text")).alias("extracted_phone"))


@query("cln8_phone_ext_and_digits")
def cln8(spark, sf):
    return _customers(spark, sf).select(
        "customer_id", text.digits_after_x(c("phone")).alias("phone_extension"), text.phone_digits_only(c("phone")).alias("phone_digits_only")
    )


@query("cln9_store_phone")
def cln9(spark, sf):
    return _stores(spark, sf).select("store_id", text.store_phone(c("phone")).alias("store_phone"))


@query("cln10_street_from_address")
def cln10(spark, sf):
    return _customers(spark, sf).select("customer_id", text.street_from_address(c("address")).alias("street_address"))


@query("cln10_first_line_of_documents")
def cln10_documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.street_from_address(c("text")).alias("street_address"))


@query("cln11_full_address")
def cln11(spark, sf):
    street = text.street_from_address(c("address"))
    return _stores(spark, sf).select("store_id", text.full_address(street, c("city"), c("state"), c("zip_code")).alias("full_address"))


@query("cln12_map_enum")
def cln12(spark, sf):
    return _customers(spark, sf).select(
        "customer_id", text.map_enum(c("gender"), text.GENDERS).alias("gender"),
        text.map_enum(c("preferred_contact"), text.CONTACTS).alias("preferred_contact"),
        text.map_enum(c("customer_segment"), text.SEGMENTS, "Unknown").alias("customer_segment"),
    )


@query("cln13_default_bool")
def cln13(spark, sf):
    return _customers(spark, sf).select("customer_id", text.default_bool(c("loyalty_member")).alias("loyalty_member"))


@query("cln14_safe_date")
def cln14(spark, sf):
    return _customers(spark, sf).select("customer_id", dates.safe_date(c("date_of_birth")).alias("date_of_birth"))


@query("cln15_date_or_from_id")
def cln15(spark, sf):
    return _lines(spark, sf).select("transaction_id", "product_id", dates.date_or_from_id(c("date"), c("transaction_id")).alias("transaction_date"))


@query("cln16_time_or_midnight")
def cln16(spark, sf):
    return _lines(spark, sf).select("transaction_id", "product_id", dates.time_or_midnight(c("time")).alias("transaction_time"))


@query("cln17_compose_datetime")
def cln17(spark, sf):
    return _lines(spark, sf).select(
        "transaction_id", "product_id", dates.compose_datetime(c("date"), c("time"), c("transaction_id")).alias("transaction_datetime")
    )


@query("cln18_date_parts")
def cln18(spark, sf):
    day = dates.date_or_from_id(c("date"), c("transaction_id"))
    parts = dates.date_parts(day, c("time"))
    return _lines(spark, sf).select("transaction_id", "product_id", *[v.alias(k) for k, v in parts.items()])


@query("cln19_strip_dup_marker")
def cln19(spark, sf):
    pair = F.concat("transaction_id", F.lit("-"), "product_id")
    return _lines(spark, sf).select(
        "transaction_id", text.strip_dup_marker(c("transaction_id")).alias("transaction_id_clean"), text.strip_dup_marker(pair).alias("transaction_product")
    )


@query("cln20_upper_trim")
def cln20(spark, sf):
    return _lines(spark, sf).select(
        "transaction_id", "product_id",
        *[text.upper_trim(c(x)).alias(x) for x in ("payment_method", "status", "promotion_code")],
    )


@query("cln21_round_money")
def cln21(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", measures.money(c("l_extendedprice") / c("l_quantity")).alias("unit_price")
    )


@query("cln22_negative_to_null")
def cln22(spark, sf):
    return _products(spark, sf).select("product_id", measures.negative_to_null(c("stock_quantity")).alias("stock_quantity"))


@query("cln23_refund_and_promotion")
def cln23(spark, sf):
    return _lines(spark, sf).select(
        "transaction_id", "product_id", measures.is_refund(c("status"), c("refund_reason")).alias("is_refund"),
        measures.has_promotion(c("promotion_code")).alias("has_promotion"),
    )


@query("cln24_coerce_stream_types")
def cln24(spark, sf):
    typed = coerce_types(parse_messages(standin.live_messages(spark, sf).drop("ts")))
    return typed.select(
        "transaction_id", "date", "time", "datetime", "customer_id", "store_id", "payment_method", "total_amount",
        "items_count", "status", "product_id", "quantity", "line_total",
    )


@query("cln25_missing_time_last")
def cln25(spark, sf):
    nested = standin.nested_transactions(spark, sf)
    return nested.select("transaction_id", dates.time_or_last_second(c("time")).alias("time")).orderBy("time", "transaction_id")


@query("mea1_discount_and_line_total")
def mea1(spark, sf):
    q, p, d = c("quantity"), c("unit_price"), c("discount_percent")
    return _lines(spark, sf).select(
        "transaction_id", "product_id", measures.discount_amount(q, p, d).alias("discount_amount"),
        measures.calculated_line_total(q, p, d).alias("calculated_line_total"),
    )


@query("mea2_profit_margin")
def mea2(spark, sf):
    return _products(spark, sf).select("product_id", measures.profit_margin_pct(c("price"), c("cost")).alias("profit_margin_pct"))


@query("mea3_line_total_clean")
def mea3(spark, sf):
    refund = measures.is_refund(c("status"), c("refund_reason"))
    clean = measures.line_total_clean(c("line_total"), c("quantity"), c("unit_price"), c("discount_percent"), refund)
    return _lines(spark, sf).select("transaction_id", "product_id", clean.alias("line_total_clean"))


@query("mea4_quantity_clean")
def mea4(spark, sf):
    refund = measures.is_refund(c("status"), c("refund_reason"))
    return _lines(spark, sf).select("transaction_id", "product_id", measures.quantity_clean(c("quantity"), refund).alias("quantity_clean"))


@query("mea5_sale_amounts")
def mea5(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    q, price = c("l_quantity").cast("bigint"), measures.money(c("l_extendedprice") / c("l_quantity"))
    pct = c("l_discount") * 100
    total = measures.calculated_line_total(q, price, pct)
    cost = F.when(c("p_retailprice") > 950, c("p_retailprice"))
    amounts = measures.sale_amounts(q, price, total, measures.discount_amount(q, price, pct), cost)
    joined = table(spark, sf, "lineitem").join(part, c("l_partkey") == c("p_partkey"), "left")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", *[measures.money(v, 4).alias(k) for k, v in amounts.items()])


@query("mea6_elapsed_time")
def mea6(spark, sf):
    born, opened = dates.safe_date(c("date_of_birth")), dates.safe_date(c("registration_date"))
    days = dates.days_since(opened, CTX.today)
    return _customers(spark, sf).select(
        "customer_id", dates.years_between(born, CTX.today).alias("age"), days.alias("days_since"),
        dates.months_between_boundaries(opened, CTX.today).alias("months_since"), dates.rounded_years(days).alias("years_since"),
    )


@query("mea7_date_key")
def mea7(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", dates.date_key(c("o_orderdate")).alias("date_key"))


@query("bkt1_age_group")
def bkt1(spark, sf):
    age = dates.years_between(dates.safe_date(c("date_of_birth")), CTX.today)
    return _customers(spark, sf).select("customer_id", buckets.age_group(age).alias("age_group"))


@query("bkt2_tenure")
def bkt2(spark, sf):
    since = dates.safe_date(c("registration_date"))
    return _customers(spark, sf).select(
        "customer_id", buckets.tenure_by_months(dates.months_between_boundaries(since, CTX.today)).alias("tenure_by_months"),
        buckets.tenure_by_days(F.datediff(CTX.today, since)).alias("tenure_by_days"),
    )


@query("bkt3_lifetime_value")
def bkt3(spark, sf):
    v = c("total_lifetime_value")
    return _customers(spark, sf).select("customer_id", buckets.ltv_tier(v).alias("ltv_tier"), buckets.ltv_category(v).alias("ltv_category"))


@query("bkt4_product_maturity")
def bkt4(spark, sf):
    d = dates.safe_date(c("launch_date"))
    return _products(spark, sf).select(
        "product_id", buckets.maturity_by_months(dates.months_between_boundaries(d, CTX.today)).alias("maturity_by_months"),
        buckets.maturity_by_days(dates.days_since(d, CTX.today)).alias("maturity_by_days"),
    )


@query("bkt5_weight_category")
def bkt5(spark, sf):
    w = c("weight")
    return _products(spark, sf).select(
        "product_id", buckets.weight_category_inclusive(w).alias("weight_inclusive"), buckets.weight_category(w).alias("weight_category")
    )


@query("bkt6_margin_tier")
def bkt6(spark, sf):
    m = measures.profit_margin_pct(c("price"), c("cost"))
    return _products(spark, sf).select(
        "product_id", buckets.margin_tier_inclusive(m).alias("margin_inclusive"), buckets.margin_tier(m).alias("margin_tier")
    )


@query("bkt7_price_tier")
def bkt7(spark, sf):
    f = flags.product_range_flags(c("price"), c("cost"), c("stock_quantity"), c("weight"))
    return _products(spark, sf).select(
        "product_id", buckets.price_tier(c("price")).alias("price_tier"),
        buckets.price_category(f["very_high_price_flag"], f["very_low_price_flag"]).alias("price_category"),
    )


@query("bkt8_stock_status")
def bkt8(spark, sf):
    stock = measures.negative_to_null(c("stock_quantity"))
    upcoming = flags.future_flag(dates.safe_date(c("launch_date")), CTX.today) == 1
    return _products(spark, sf).select(
        "product_id", buckets.stock_status(c("stock_quantity")).alias("stock_status"),
        *[v.alias(k) for k, v in buckets.stock_flags(stock).items()], upcoming.alias("is_upcoming"),
    )


@query("bkt9_store_age")
def bkt9(spark, sf):
    opened = dates.safe_date(c("opening_date"))
    days = dates.days_since(opened, CTX.today)
    return _stores(spark, sf).select(
        "store_id", buckets.store_age_category(opened, F.datediff(CTX.today, opened), CTX.today).alias("store_age_category"),
        buckets.store_maturity_tier(dates.rounded_years(days)).alias("store_maturity_tier"),
        (flags.very_old_flag(opened, CTX.today) == 1).alias("is_legacy_store"),
    )


@query("bkt10_store_class")
def bkt10(spark, sf):
    return _stores(spark, sf).select(
        "store_id", buckets.store_category(text.upper_trim(c("store_type"))).alias("store_category"),
        buckets.region(c("state")).alias("region"), buckets.is_metro_area(text.strip_non_printable(c("city"))).alias("is_metro_area"),
    )


@query("bkt11_fully_operational")
def bkt11(spark, sf):
    opened = dates.safe_date(c("opening_date"))
    return _stores(spark, sf).select(
        "store_id", buckets.is_fully_operational(opened, c("phone"), c("manager"), CTX.today).alias("is_fully_operational")
    )


@query("bkt12_calendar_class")
def bkt12(spark, sf):
    dow, hour = dates.weekday(c("ts")), F.hour("ts")
    return table(spark, sf, "events").select(
        "event_id", buckets.is_weekend(dow).alias("is_weekend"), buckets.day_name(dow).alias("day_name"),
        buckets.time_of_day(hour).alias("time_of_day"),
    )


@query("bkt13_sale_flags")
def bkt13(spark, sf):
    out = buckets.sale_flags(c("quantity"), c("line_total"), c("discount_percent"), c("loyalty_points_earned"))
    return _lines(spark, sf).select("transaction_id", "product_id", *[v.alias(k) for k, v in out.items()])


@query("bkt14_transaction_type")
def bkt14(spark, sf):
    kind = buckets.transaction_type(
        measures.is_refund(c("status"), c("refund_reason")), measures.has_promotion(c("promotion_code")), c("discount_percent")
    )
    return _lines(spark, sf).select("transaction_id", "product_id", kind.alias("transaction_type"))


@query("flg1_missing_flag")
def flg1(spark, sf):
    names = ("city", "state", "zip_code", "email", "phone")
    return _customers(spark, sf).select("customer_id", *[flags.missing_flag(c(n)).alias(f"missing_{n}_flag") for n in names])


@query("flg2_range_flags")
def flg2(spark, sf):
    out = flags.product_range_flags(c("price"), c("cost"), c("stock_quantity"), c("weight"))
    return _products(spark, sf).select("product_id", *[v.alias(k) for k, v in out.items()])


@query("flg3_cross_column_flags")
def flg3(spark, sf):
    computed = measures.calculated_line_total(c("quantity"), c("unit_price"), c("discount_percent"))
    out = flags.sale_range_flags(
        c("quantity"), c("unit_price"), c("line_total"), computed, c("total_amount"), c("status"), c("refund_reason")
    )
    return _lines(spark, sf).select("transaction_id", "product_id", *[v.alias(k) for k, v in out.items()])


@query("flg4_address_mismatch")
def flg4(spark, sf):
    parts = (("city", "city"), ("state", "state"), ("zip_code", "zip"))
    return _customers(spark, sf).select(
        "customer_id", *[flags.address_mismatch(c("address"), c(p)).alias(f"address_{a}_mismatch_flag") for p, a in parts]
    )


@query("flg5_date_flags")
def flg5(spark, sf):
    opened = dates.safe_date(c("opening_date"))
    return _stores(spark, sf).select(
        "store_id", flags.future_flag(opened, CTX.today).alias("future_opening_date_flag"),
        flags.very_old_flag(opened, CTX.today).alias("very_old_store_flag"),
    )


@query("flg6_phone_flags")
def flg6(spark, sf):
    phone = text.phone_extract(c("phone"))
    return _customers(spark, sf).select(
        "customer_id", flags.invalid_phone_flag(phone).alias("invalid_phone_flag"),
        flags.phone_too_short_flag(text.phone_digits(c("phone"))).alias("phone_too_short_flag"),
    )


@query("flg7_zip_flags")
def flg7(spark, sf):
    out = staging.zip_flags(_customers(spark, sf), standin.zip_lookup(spark, sf))
    return out.select("customer_id", "invalid_zip_code_flag", "state_zip_mismatch_flag")


@query("flg8_quality_score")
def flg8(spark, sf):
    return Warehouse(spark, sf).intmd_customers().select("customer_id", "quality_issues_count", "quality_tier")


@query("flg9_completeness")
def flg9(spark, sf):
    wh = Warehouse(spark, sf)
    stores = wh.intmd_stores().select(c("store_id").alias("id"), "address_quality", c("store_data_quality").alias("data_quality"))
    goods = wh.intmd_products().select(
        c("product_id").alias("id"), F.lit(None).cast("string").alias("address_quality"), c("product_data_quality").alias("data_quality")
    )
    return stores.unionByName(goods)


@query("flg10_data_quality_status")
def flg10(spark, sf):
    return Warehouse(spark, sf).intmd_transactions().select(
        "line_item_key", "data_quality_status", "had_negative_quantity", "had_negative_amount", "had_zero_total",
        "had_missing_time", "had_missing_cashier", "had_high_unit_price",
    )


@query("key1_row_hash")
def key1(spark, sf):
    h = flags.row_hash(
        c("l_orderkey"), c("l_linenumber"), c("l_returnflag"), flags.as_text(c("l_extendedprice")), flags.as_text(c("l_discount")), c("l_shipdate").cast("date")
    )
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", h.alias("row_hash"))


@query("key2_surrogate_key")
def key2(spark, sf):
    return _lines(spark, sf).select(
        "transaction_id", "product_id", flags.surrogate_key(text.strip_dup_marker(c("transaction_id")), c("product_id")).alias("line_item_key")
    )


@query("key3_unknown_member")
def key3(spark, sf):
    products = Warehouse(spark, sf).dim("products").select("product_id", "product_key")
    looked_up = _lines(spark, sf).select("transaction_id", "product_id").join(products, "product_id", "left")
    return looked_up.select(
        "transaction_id", "product_id", F.coalesce("product_key", flags.unknown_product_key(c("product_id"))).alias("product_key"),
        flags.unknown_member_key().alias("unknown_store_key"),
    )


@query("aud1_audit_columns")
def aud1(spark, sf):
    return _customers(spark, sf).select(
        "customer_id", c("modified_date").alias("raw_loaded_at"), CTX.now.alias("staging_loaded_at"),
        *[v.alias(k) for k, v in flags.audit_columns(CTX, "raw_customers").items()],
    )
