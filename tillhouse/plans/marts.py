"""Dimensions, the sales fact and the business marts (DIM*, FCT1, MRT*)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.context import DEFAULT, RunContext
from tillhouse.functions import buckets, dates, flags, measures
from tillhouse.functions.flags import packed_key, unpacked_key
from tillhouse.operators import ranking, scd
from tillhouse.operators.dedup import DEALT, DEALT_TRANSACTION, SALTS
from tillhouse.session import materialise

# Columns kept per dimension and those whose change opens a version.
CUSTOMER_ATTRIBUTES = [
    "first_name", "last_name", "full_name", "gender", "date_of_birth", "age", "age_group", "email", "phone",
    "phone_extension", "phone_digits_only", "street_address", "city", "state", "zip_code", "state_code_from_zip",
    "state_name_from_zip", "county_name", "fips_code", "latitude", "longitude", "registration_date",
    "days_since_registration", "customer_tenure_category", "customer_segment", "lifetime_value", "ltv_category",
    "quality_tier", "quality_issues_count",
]
CUSTOMER_TRACKED = ["street_address", "city", "state", "zip_code", "customer_segment", "ltv_category", "customer_tenure_category"]
PRODUCT_ATTRIBUTES = [
    "product_name", "category", "subcategory", "brand", "sku", "supplier", "selling_price", "cost_price",
    "profit_margin_pct", "price_tier", "price_category", "stock_quantity", "stock_status", "is_available",
    "is_out_of_stock", "is_low_stock", "weight", "weight_category", "dimensions", "launch_date", "days_since_launch",
    "product_maturity", "is_upcoming", "margin_tier", "product_data_quality",
]
PRODUCT_TRACKED = ["selling_price", "cost_price", "category", "subcategory", "supplier", "price_tier", "price_category"]
STORE_ATTRIBUTES = [
    "store_name", "store_type", "store_category", "manager", "store_address", "full_address", "city", "state",
    "zip_code", "region", "is_metro_area", "store_phone", "opening_date", "days_since_opening", "years_since_opening",
    "store_age_category", "store_maturity_tier", "is_fully_operational", "is_legacy_store", "address_quality",
    "store_data_quality",
]
STORE_TRACKED = ["manager", "store_type", "store_category", "is_fully_operational", "region"]
DIMENSIONS = {
    "customers": ("customer_id", "customer_key", CUSTOMER_ATTRIBUTES, CUSTOMER_TRACKED),
    "products": ("product_id", "product_key", PRODUCT_ATTRIBUTES, PRODUCT_TRACKED),
    "stores": ("store_id", "store_key", STORE_ATTRIBUTES, STORE_TRACKED),
}
LOOKED_UP = ["customer_key", "product_key", "store_key", "cost_price"]
CALENDAR_START, CALENDAR_END = dt.date(2020, 1, 1), dt.date(2031, 1, 1)
BUYER_TYPES = [
    ("<=", 1, "One-Time Buyer"), ("<=", 2, "Occasional Buyer (2 purchases)"), ("<=", 5, "Regular Buyer (3-5 purchases)"),
    ("<=", 10, "Frequent Buyer (6-10 purchases)"),
]
ACTIVITY = [("<=", 30, "Active (Last 30 days)"), ("<=", 60, "Recent (Last 60 days)"), ("<=", 90, "At Risk (60-90 days)")]
VALUE_TIERS = [(">=", 1000, "High Value ($1000+)"), (">=", 500, "Medium Value ($500-$1000)"), (">=", 100, "Low Value ($100-$500)")]
VELOCITY = [("<=", 7, "Hot Seller"), ("<=", 30, "Active"), ("<=", 90, "Slow Moving")]
ABC = [("<=", 0.80, "A - Top Products"), ("<=", 0.95, "B - Medium Products")]
# Our own cut-offs, where only the labels are given.
MARGIN_STATUS = [(">=", 40, "Excellent Margin"), (">=", 25, "Good Margin"), (">=", 10, "Fair Margin")]
WEEKLY_GAP_DAYS, MONTHLY_GAP_DAYS = 10, 45


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """GEN1: one row per day of [start, end)."""
    days = F.sequence(F.lit(start), F.date_sub(F.lit(end), 1))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def date_series(spark: SparkSession, start: dt.date, days: int) -> DataFrame:
    """GEN2: the same from an integer series, spread over the cluster."""
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("expected_date"))


def widened(start: dt.date, days: int, held: DataFrame) -> tuple[dt.date, int]:
    """``start`` and ``days`` of a series, widened to the days of the one column of ``held``."""
    day = F.col(held.columns[0])
    first, last = held.agg(F.min(day), F.max(day)).first()
    if first is None:
        return start, days
    begin, end = min(start, first), max(start + dt.timedelta(days - 1), last)
    return begin, (end - begin).days + 1


def dim_date(days: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """DIM1: calendar attributes; the relative flags hold for ``ctx.as_of``."""
    d, today = F.col("date_day"), ctx.today
    text = lambda c: c.cast("string")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    year, quarter, month, week = F.year(d), F.quarter(d), F.month(d), F.weekofyear(d)
    dow = dates.weekday(d)
    month_name, day_name = F.date_format(d, "MMMM"), F.date_format(d, "EEEE")
    fourth_thursday = (month == 11) & F.day(d).between(22, 28) & (dow == 4)
    holiday = (
        F.when((month == 1) & (F.day(d) == 1), "New Year's Day")
        .when((month == 7) & (F.day(d) == 4), "Independence Day")
        .when((month == 12) & (F.day(d) == 25), "Christmas Day")
        .when(fourth_thursday, "Thanksgiving")
    )
    same = lambda unit: F.trunc(d, unit) == F.trunc(today, unit)
    last = lambda n: d.between(F.date_sub(today, n), today)
    y_name = F.concat(F.lit("Y"), text(year))
    return days.select(
        dates.date_key(d).alias("date_key"), d.alias("date_actual"),
        year.alias("year"), y_name.alias("year_name"),
        quarter.alias("quarter"), F.concat(F.lit("Q"), text(quarter)).alias("quarter_name"),
        F.concat(y_name, F.lit("-Q"), text(quarter)).alias("year_quarter"),
        month.alias("month"), month_name.alias("month_name"), F.substring(month_name, 1, 3).alias("month_name_short"),
        F.concat(y_name, F.lit("-M"), two(month)).alias("year_month"),
        week.alias("week_of_year"), F.concat(F.lit("W"), two(week)).alias("week_name"),
        F.concat(y_name, F.lit("-W"), two(week)).alias("year_week"),
        F.day(d).alias("day_of_month"), F.dayofyear(d).alias("day_of_year"), dow.alias("day_of_week"),
        day_name.alias("day_name"), F.substring(day_name, 1, 3).alias("day_name_short"),
        dow.isin(0, 6).alias("is_weekend"), dow.between(1, 5).alias("is_weekday"),
        holiday.alias("holiday_name"), holiday.isNotNull().alias("is_holiday"),
        year.alias("fiscal_year"), quarter.alias("fiscal_quarter"), month.alias("fiscal_month"),
        (d == today).alias("is_today"), (d == F.date_sub(today, 1)).alias("is_yesterday"),
        (d == F.date_add(today, 1)).alias("is_tomorrow"),
        same("week").alias("is_current_week"), same("month").alias("is_current_month"),
        same("quarter").alias("is_current_quarter"), same("year").alias("is_current_year"),
        *[last(n).alias(f"is_last_{n}_days") for n in (7, 30, 90, 365)],
        (F.day(d) == 1).alias("is_first_day_of_month"), (d == F.last_day(d)).alias("is_last_day_of_month"),
        ctx.now.alias("created_at"),
    )


def load_dimension(name: str, batch: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """DIM2-DIM4, first load."""
    id_col, key_col, attributes, _ = DIMENSIONS[name]
    return scd.initial_load(batch, id_col, key_col, attributes, ctx.now)


def merge_dimension(name: str, dim: DataFrame, batch: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """DIM2-DIM4, later loads."""
    id_col, key_col, attributes, tracked = DIMENSIONS[name]
    return scd.merge(dim, batch, id_col, key_col, attributes, tracked, ctx.now)


def _lookup(dim: DataFrame, key: str, *carried: Column) -> DataFrame:
    """What a lookup by ``key`` brings, one row per key: Spark then drops a lookup whose columns nobody reads."""
    names = [f"_{i}" for i in range(len(carried))]
    found = dim.groupBy(key).agg(F.max(F.struct(*[v.alias(n) for n, v in zip(names, carried, strict=True)])).alias("_found"))
    return found.select(key, "_found.*")


def star_lookup(sales: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """JOI3: current versions by id; only keys and the cost travel.

    No broadcast hints: Spark broadcasts a dimension while its size allows and
    shuffles it once it does not, splitting skewed partitions.  Store keys are stored first: Spark then sees how
    few they are, where its estimate through their plan has all lines shuffled by store.
    Keys travel packed: as text a hash takes twice its bytes, which nothing compresses.
    Lines of :func:`dedup.dealt_by_product` meet their products where they lie, and their customers afterwards.
    """
    c = F.col
    cust = _lookup(scd.current(customers), "customer_id", packed_key(c("customer_key"))).toDF("customer_id", "_customer")
    goods = scd.current(products).select("product_id", packed_key(c("product_key")).alias("_key"), "cost_price")
    shop = materialise(scd.current(stores).select("store_id", packed_key(c("store_key")).alias("_key")), "store-keys")
    shop = _lookup(shop, "store_id", c("_key")).toDF("store_id", "_shop")
    if set(DEALT) <= set(sales.columns):
        places = goods.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
        prod = places.groupBy(c("product_id").alias("_product"), "_salt").agg(F.max(F.struct("_key", "cost_price")).alias("_found"))
        prod = prod.select(*DEALT, c("_found._key").alias("_good"), "_found.cost_price")
        found = sales.join(prod, DEALT, "left").join(cust, "customer_id", "left")
    else:
        prod = _lookup(goods, "product_id", c("_key"), c("cost_price")).toDF("product_id", "_good", "cost_price")
        found = sales.join(cust, "customer_id", "left").join(prod, "product_id", "left")
    found = found.join(shop, "store_id", "left")
    ids = ["customer_id", "product_id", "store_id"]
    return found.select(
        *ids, *[n for n in sales.columns if n not in (*ids, *DEALT, *DEALT_TRANSACTION)], unpacked_key(c("_shop")).alias("store_key"),
        unpacked_key(c("_good")).alias("product_key"), "cost_price", unpacked_key(c("_customer")).alias("customer_key"),
    )


def fact_sales(lines: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """FCT1: one row per sold line with dimension keys and amounts."""
    return sold_lines(star_lookup(lines, customers, products, stores), ctx)


def sold_lines(looked_up: DataFrame, ctx: RunContext = DEFAULT, also: list[Column] | None = None) -> DataFrame:
    """FCT1 from lines that carry what :func:`star_lookup` adds; ``also`` are further columns."""
    c = F.col
    amounts = measures.sale_amounts(
        c("quantity_clean"), c("unit_price"), c("line_total_clean"), c("discount_amount"), c("cost_price")
    )
    return looked_up.select(
        c("line_item_key").alias("sales_key"), dates.date_key(c("transaction_date")).alias("date_key"),
        F.coalesce("customer_key", flags.unknown_member_key()).alias("customer_key"),
        F.coalesce("product_key", flags.unknown_product_key(c("product_id"))).alias("product_key"),
        F.coalesce("store_key", flags.unknown_member_key()).alias("store_key"),
        "transaction_id", "cashier_id", "promotion_code", "refund_reason", "store_name",
        "transaction_date", "transaction_time", "transaction_datetime", "transaction_year", "transaction_month",
        "transaction_day", "transaction_hour", "payment_method", "payment_status", "transaction_type",
        "is_refund", "has_promotion", "has_discount", "is_weekend", "is_multi_quantity", "is_bulk_purchase",
        "is_high_value_item", "earned_loyalty_points", "day_name", "time_of_day", "product_name", "category",
        c("quantity_clean").alias("quantity"), "items_count", "unit_price", "discount_percent",
        c("line_total_clean").alias("line_total"), "discount_amount", "subtotal", "tax_amount", "total_amount",
        *[v.alias(k) for k, v in amounts.items()],
        "loyalty_points_earned", "data_quality_status", "had_negative_quantity", "had_negative_amount",
        "had_zero_total", "had_missing_time", "had_missing_cashier", "had_high_unit_price",
        c("raw_loaded_at").alias("date_of_creation"), "staging_processed_at",
        c("intermediate_processed_at").alias("fact_loaded_at"), "_source_system", ctx.now.alias("created_at"), *(also or []),
    )


def _ratio(a, b):
    """a / b as a double, NULL for a zero or missing divisor."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def daily_sales(fact: DataFrame) -> DataFrame:
    """Daily totals without refunds."""
    return fact.where("not is_refund").groupBy(F.col("transaction_date").alias("date")).agg(
        (F.sum(measures.cents(F.col("line_total"))) / 100.0).alias("revenue"),
        (F.sum(measures.cents(F.col("total_cost"))) / 100.0).alias("cost"),
        F.countDistinct("transaction_id").alias("transactions"),
        F.countDistinct("customer_key").alias("customers"),
        F.sum("quantity").alias("units_sold"),
    )


def with_missing_days(daily: DataFrame) -> DataFrame:
    """The daily series with zero rows for days without sales (lags count days)."""
    edge = daily.agg(F.min("date").alias("a"), F.max("date").alias("b")).where("a is not null")
    spine = edge.select(F.explode(F.sequence("a", "b")).alias("date"))
    # At most one row per calendar day on both sides.
    return spine.join(daily, "date", "left").na.fill(0).na.fill(0.0)


def revenue_performance(fact: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """MRT1: one row per day with sales.

    The windows run over one row per calendar day, a bound that does not grow
    with the sales.  The days are stored, as they are read twice.
    """
    d = F.col("date")
    spined = with_missing_days(materialise(daily_sales(fact), "daily-sales")).withColumn("y", F.year(d)).withColumn("m", F.month(d))
    money = measures.money_total
    windowed = spined.select(
        "*",
        money(ranking.day_change("revenue", "date", 1)).alias("revenue_change_vs_yesterday"),
        money(ranking.day_change("revenue", "date", 7)).alias("revenue_change_vs_last_week"),
        money(ranking.rolling_mean("revenue", "date", 7)).alias("revenue_7day_avg"),
        money(ranking.rolling_mean("revenue", "date", 30)).alias("revenue_30day_avg"),
        money(ranking.running_total("revenue", "date", "y", "m")).alias("revenue_mtd"),
        money(ranking.running_total("revenue", "date", "y")).alias("revenue_ytd"),
    ).where("transactions > 0")
    profit = F.col("revenue") - F.col("cost")
    last = lambda n: d.between(F.date_sub(ctx.today, n - 1), ctx.today)
    return windowed.select(
        "date", F.col("y").alias("year"), F.quarter(d).alias("quarter"), F.col("m").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "EEEE").alias("day_name"),
        F.when(buckets.is_weekend(dates.weekday(d)), "Weekend").otherwise("Weekday").alias("day_type"),
        "revenue", "cost", money(profit).alias("profit"),
        money(_ratio(profit, F.col("revenue")) * 100).alias("profit_margin_pct"),
        "transactions", "customers", "units_sold",
        money(_ratio(F.col("revenue"), F.col("transactions"))).alias("avg_order_value"),
        "revenue_change_vs_yesterday", "revenue_change_vs_last_week", "revenue_7day_avg", "revenue_30day_avg",
        "revenue_mtd", "revenue_ytd",
        (d == ctx.today).alias("is_today"), last(7).alias("is_last_7_days"), last(30).alias("is_last_30_days"),
    )


def _totals(fact: DataFrame, key: str) -> DataFrame:
    """Per key: the sums and distinct counts the store and product marts share; keys travel packed."""
    money = measures.money_total
    sold = fact.where("not is_refund").withColumns({"_key": packed_key(F.col(key)), "_buyer": packed_key(F.col("customer_key"))})
    return sold.groupBy("_key").agg(
        F.sum(measures.cents(F.col("line_total"))).alias("revenue_cents"),
        F.sum(measures.cents(F.col("line_profit"))).alias("profit_cents"),
        F.countDistinct("transaction_id").alias("total_transactions"),
        F.countDistinct("_buyer").alias("buyers"),
        F.countDistinct("transaction_date").alias("days_with_sales"),
        F.sum("quantity").alias("total_units_sold"),
        money(F.avg(_ratio(F.col("line_total"), F.col("quantity")))).alias("avg_actual_price"),
        F.min("transaction_date").alias("first_sale_date"),
        F.max("transaction_date").alias("last_sale_date"),
    ).withColumn(key, unpacked_key(F.col("_key"))).drop("_key")


def _percentile_rank(rank: str, total: str):
    """WIN9: 0 for the best, 1 for the last."""
    return (F.col(rank) - 1).cast("double") / F.greatest(F.col(total) - 1, F.lit(1)).cast("double")


def store_performance(fact: DataFrame, stores: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """MRT2: one row per store with sales; sales of unknown stores share one row."""
    money = measures.money_total
    shops = scd.current(stores).select("store_key", "store_id", "store_name", "city", "state", "manager", "region")
    base = materialise(
        _totals(fact, "store_key").join(shops, "store_key", "left")
        .withColumns({c: F.coalesce(c, F.lit("Unknown")) for c in ("store_id", "store_name", "city", "state", "region")}),
        "store-totals",
    )
    ranked = ranking.global_ranks(base, {"revenue_cents": "revenue_rank", "profit_cents": "profit_rank"}, materialise)
    ranked = ranking.rank_in_group(ranked, "region", "revenue_cents", "rank_in_region", materialise)
    counted = ranked.crossJoin(F.broadcast(base.agg(F.count("*").alias("_stores"))))
    pct = _percentile_rank("revenue_rank", "_stores")
    revenue, profit = F.col("revenue_cents") / 100.0, F.col("profit_cents") / 100.0
    margin = money(_ratio(profit, revenue) * 100)
    tier = (
        F.when(F.col("revenue_rank") <= 3, "Top 3").when(pct <= 0.25, "Top 25%").when(pct <= 0.50, "Above Average")
        .when(pct <= 0.75, "Below Average").otherwise("Bottom 25%")
    )
    return counted.select(
        "store_id", "store_name", "city", "state", "manager",
        money(revenue).alias("total_revenue"), money(profit).alias("total_profit"), margin.alias("profit_margin_pct"),
        "total_transactions", F.col("buyers").alias("total_customers"), "total_units_sold",
        money(_ratio(revenue, F.col("days_with_sales"))).alias("avg_daily_revenue"),
        money(_ratio(F.col("total_transactions"), F.col("days_with_sales"))).alias("avg_daily_transactions"),
        money(_ratio(revenue, F.col("buyers"))).alias("revenue_per_customer"),
        money(_ratio(F.col("total_transactions"), F.col("buyers"))).alias("transactions_per_customer"),
        "revenue_rank", "profit_rank", "rank_in_region", tier.alias("performance_tier"),
        buckets.ladder(margin, MARGIN_STATUS, "Low Margin").alias("margin_status"),
        "first_sale_date", "last_sale_date", "days_with_sales",
        F.datediff(ctx.today, F.col("last_sale_date")).alias("days_since_last_sale"),
    )


def products_performance(fact: DataFrame, products: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """MRT3: one row per known product with sales."""
    money = measures.money_total
    goods = scd.current(products).select(
        "product_key", "product_id", "product_name", "category", "subcategory", "brand", "selling_price", "cost_price"
    )
    base = materialise(_totals(fact, "product_key").join(goods, "product_key"), "product-totals")
    ranked = ranking.global_ranks(
        base, {"revenue_cents": "revenue_rank", "profit_cents": "profit_rank", "total_units_sold": "units_rank"}, materialise
    )
    ranked = ranking.rank_in_group(ranked, "category", "revenue_cents", "rank_in_category", materialise)
    ranked = ranking.running_share(ranked, "revenue_cents", "_share", materialise)
    counted = ranked.crossJoin(F.broadcast(base.agg(F.count("*").alias("_products"))))
    pct = _percentile_rank("revenue_rank", "_products")
    revenue, profit = F.col("revenue_cents") / 100.0, F.col("profit_cents") / 100.0
    margin = money(_ratio(profit, revenue) * 100)
    tier = F.when(F.col("revenue_rank") <= 10, "Top 10").when(pct <= 0.20, "Top 20%").when(pct <= 0.50, "Top 50%").otherwise("Bottom 50%")
    status = (
        F.when(profit < 0, "Loss Maker").when(margin >= 40, "High Margin Winner")
        .when(pct <= 0.20, "Volume Driver").otherwise("Profitable")
    )
    idle = F.datediff(ctx.today, F.col("last_sale_date"))
    return counted.select(
        "product_id", "product_name", "category", "subcategory", "brand", F.col("selling_price").alias("list_price"),
        "cost_price", "avg_actual_price",
        money(revenue).alias("total_revenue"), money(profit).alias("total_profit"), margin.alias("profit_margin_pct"),
        "total_units_sold", "total_transactions", F.col("buyers").alias("unique_customers"),
        money(_ratio(revenue, F.col("days_with_sales"))).alias("avg_daily_revenue"),
        money(_ratio(F.col("total_units_sold"), F.col("days_with_sales"))).alias("avg_daily_units"),
        money(_ratio(revenue, F.col("buyers"))).alias("revenue_per_customer"),
        money(_ratio(F.col("total_units_sold"), F.col("buyers"))).alias("units_per_customer"),
        "revenue_rank", "profit_rank", "units_rank", "rank_in_category", tier.alias("performance_tier"),
        buckets.ladder(F.col("_share"), ABC, "C - Low Products").alias("abc_class"), status.alias("profit_status"),
        buckets.ladder(idle, VELOCITY, "Dormant").alias("sales_velocity"),
        "first_sale_date", "last_sale_date", "days_with_sales", idle.alias("days_since_last_sale"),
    )


def customer_metrics(fact: DataFrame, customers: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """MRT4: one row per known customer with purchases.

    Exactly ten purchases count as 'Frequent'; 'VIP' starts above ten.
    """
    money = measures.money_total
    people = scd.current(customers).select(
        "customer_key", "customer_id", "full_name", "customer_segment", "age_group", "city", "state", "registration_date"
    )
    totals = fact.where("not is_refund").groupBy("customer_key").agg(
        F.countDistinct("transaction_id").alias("total_purchases"),
        F.countDistinct("transaction_date").alias("days_purchased"),
        F.countDistinct(F.trunc("transaction_date", "MM")).alias("months_active"),
        money(F.sum("line_total")).alias("lifetime_revenue"),
        F.min("transaction_date").alias("first_purchase_date"),
        F.max("transaction_date").alias("last_purchase_date"),
    )
    n = F.col("total_purchases")
    span = F.datediff("last_purchase_date", "first_purchase_date")
    idle = F.datediff(ctx.today, F.col("last_purchase_date"))
    gap = _ratio(span, F.col("days_purchased") - 1)
    pattern = (
        F.when(n == 1, "Single Purchase").when(F.col("days_purchased") == 1, "Same Day Purchases")
        .when(gap <= WEEKLY_GAP_DAYS, "Weekly Buyer").when(gap <= MONTHLY_GAP_DAYS, "Monthly Buyer").otherwise("Irregular Buyer")
    )
    return totals.join(people, "customer_key").select(
        "customer_id", "full_name", "customer_segment", "age_group", "city", "state",
        "total_purchases", "days_purchased", "months_active", "lifetime_revenue",
        money(_ratio(F.col("lifetime_revenue"), n)).alias("avg_purchase_value"),
        "first_purchase_date", "last_purchase_date", "registration_date",
        span.alias("customer_lifespan_days"), idle.alias("days_since_last_purchase"),
        money(_ratio(n, F.col("months_active"))).alias("purchases_per_month"),
        buckets.ladder(n, BUYER_TYPES, "VIP Buyer (10+ purchases)").alias("buyer_type"),
        buckets.ladder(idle, ACTIVITY, "Inactive (90+ days)").alias("activity_status"),
        buckets.ladder(F.col("lifetime_revenue"), VALUE_TIERS, "Very Low Value (<$100)").alias("value_tier"),
        pattern.alias("purchase_pattern"),
    )


def revenue_consistency(revenue: DataFrame, stores: DataFrame) -> DataFrame:
    """MRT5: the daily and the store mart must hold the same revenue."""
    by_day = revenue.agg(measures.money_total(F.sum("revenue")).alias("daily_revenue"))
    by_store = stores.agg(measures.money_total(F.sum("total_revenue")).alias("store_revenue"))
    both = by_day.crossJoin(by_store)
    return both.withColumn("consistent", F.col("daily_revenue") == F.col("store_revenue"))
