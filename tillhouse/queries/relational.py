"""FIL*, JOI*, AGG*, WIN*, SRT*, SET*, GEN*: filters, joins, aggregates and windows."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tillhouse.context import DEFAULT as CTX
from tillhouse.functions import flags, text
from tillhouse.functions.measures import cents, money, money_total
from tillhouse.operators import dedup, incremental, ranking, scd, streams
from tillhouse.plans import intermediate, marts, profiles, reports
from tillhouse.plans.inputs import FIRST_RUN, Warehouse
from tillhouse.queries.registry import query
from tillhouse.session import materialise, shared_folder
from tillhouse.sources import standin
from tillhouse.sources.dimensions import Dimension
from tillhouse.sources.files import table

c = F.col
CUT = dt.datetime(1999, 1, 1)


# ---- filters -------------------------------------------------------------

@query("fil1_customer_admission")
def fil1(spark, sf):
    return intermediate.admit_customers(Warehouse(spark, sf).stg_customers()).select("customer_id", "email", "city", "state", "zip_code")


@query("fil2_product_admission")
def fil2(spark, sf):
    return intermediate.admit_products(Warehouse(spark, sf).stg_products()).select("product_id", "product_name_raw", "category")


@query("fil3_store_admission")
def fil3(spark, sf):
    return intermediate.admit_stores(Warehouse(spark, sf).stg_stores()).select("store_id", "store_phone", "opening_date")


@query("fil4_transaction_admission")
def fil4(spark, sf):
    lines = dedup.latest_line(Warehouse(spark, sf).stg_transactions())
    return intermediate.admit_transactions(lines).select("transaction_id_clean", "product_id", "total_amount", "is_refund")


@query("fil5_predicates")
def fil5(spark, sf):
    return table(spark, sf, "part").where(
        c("p_name").rlike("^(small|red|blue) ") & c("p_type").like("%M%") & c("p_brand").isin("Brand#1", "Brand#2", "Brand#3", "Brand#4")
        & c("p_retailprice").between(900, 980) & c("p_size").isNotNull()
    ).select("p_partkey", "p_name", "p_brand")


@query("fil6_null_safe_change")
def fil6(spark, sf):
    first, second = Warehouse(spark, sf).dim_batches("customers")
    tracked = marts.CUSTOMER_TRACKED
    old = first.select("customer_id", *tracked).alias("o")
    new = second.select("customer_id", *tracked).alias("n")
    both = old.join(new, c("o.customer_id") == c("n.customer_id"))
    return both.where(scd.changed(tracked, "o", "n")).select("n.customer_id", "n.customer_tenure_category")


@query("fil7_high_water_mark")
def fil7(spark, sf):
    lines = Warehouse(spark, sf).stg_transactions().select("transaction_id_raw", "product_id", "raw_loaded_at", "staging_processed_at")
    held = table(spark, sf, "lineitem").where(c("l_returnflag") == "N").select(F.least("l_shipdate", F.lit(str(CUT)).cast("timestamp_ntz")).alias("at"))
    return incremental.newer_than_target(lines, "raw_loaded_at", held, "at")


@query("fil8_drop_marked_duplicates")
def fil8(spark, sf):
    return streams.drop_marked_duplicates(standin.raw_transactions(spark, sf)).select("transaction_id", "product_id", "quantity")


# ---- joins ---------------------------------------------------------------

@query("joi1_inner_equi")
def joi1(spark, sf):
    raw = standin.raw_customers(spark, sf)
    phones = raw.select("customer_id", text.phone_extract(c("phone")).alias("extracted_phone"))
    return raw.select("customer_id", "email").join(phones, "customer_id")


@query("joi2_left_lookup")
def joi2(spark, sf):
    staged = standin.raw_customers(spark, sf).select("customer_id", "zip_code")
    return intermediate.customer_zip_lookup(staged, standin.zip_lookup(spark, sf))


@query("joi3_star_lookup")
def joi3(spark, sf):
    wh = Warehouse(spark, sf)
    lines = wh.intmd_transactions().select("transaction_id", "customer_id", "product_id", "store_id")
    found = marts.star_lookup(lines, wh.dim("customers"), wh.dim("products"), wh.dim("stores"))
    # The line's key, a hash that does not compress, is made from its parts after they have travelled.
    key = flags.surrogate_key(c("transaction_id"), c("product_id")).alias("line_item_key")
    return found.select(*[key if n == "transaction_id" else n for n in found.columns])


@query("joi4_one_row_cross_join")
def joi4(spark, sf):
    one = table(spark, sf, "orders").agg(F.max("o_orderdate").alias("newest_order"), F.count("*").alias("orders"))
    # One aggregated row.
    return table(spark, sf, "customer").select("c_custkey", "c_name").crossJoin(F.broadcast(one))


@query("joi5_semi_membership")
def joi5(spark, sf):
    zips = standin.zip_lookup(spark, sf).select("zip_code", c("state_name").alias("state"))
    return standin.raw_customers(spark, sf).select("customer_id", "state", "zip_code").join(zips, ["zip_code", "state"], "left_semi")


@query("joi6_anti_not_exists")
def joi6(spark, sf):
    wh = Warehouse(spark, sf)
    held = wh.stg_customers().where(c("registration_date") < F.lit(dt.date(1999, 1, 1)))
    return incremental.hash_changes(wh.stg_customers(), held, "customer_id").select("customer_id", "_row_hash")


@query("joi7_anti_calendar_gaps")
def joi7(spark, sf):
    """Days without an order, between the first and the last day that has one."""
    days = table(spark, sf, "orders").select(c("o_orderdate").cast("date").alias("expected_date")).distinct()
    edge = table(spark, sf, "orders").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    spine = edge.select(F.explode(F.sequence("a", "b")).alias("expected_date"))
    return spine.join(days, "expected_date", "left_anti")


@query("joi8_new_or_changed")
def joi8(spark, sf):
    first, second = Warehouse(spark, sf).dim_batches("products")
    dim = marts.load_dimension("products", first)
    return scd.new_or_changed(dim, second, "product_id", marts.PRODUCT_TRACKED).select("product_id", "supplier").distinct()


@query("joi9_rows_to_close")
def joi9(spark, sf):
    first, second = Warehouse(spark, sf).dim_batches("products")
    dim = marts.load_dimension("products", first)
    changes = scd.new_or_changed(dim, second, "product_id", marts.PRODUCT_TRACKED)
    return scd.closed_versions(dim, changes, "product_id", CTX.now).select("product_id", "product_key", "valid_end_date", "is_current")


@query("joi10_store_enrichment")
def joi10(spark, sf):
    live = streams.coerce_types(streams.parse_messages(standin.live_messages(spark, sf).drop("ts")))
    stores = standin.live_stores(spark, sf)
    return streams.enrich_with_stores(live, stores).select("transaction_id", "product_id", "store_id", "store_name")


# ---- aggregates ----------------------------------------------------------

@query("agg1_staging_profile")
def agg1(spark, sf):
    staged = Warehouse(spark, sf).stg_transactions().select(*profiles.STAGING_COLUMNS)
    return profiles.staging_profile(materialise(staged, "staged"))


@query("agg2_staging_grades")
def agg2(spark, sf):
    return profiles.grade_staging(agg1(spark, sf)).select(
        "profile_date", "line_item_grain_health", "transaction_size_health", "health_status", "quality_tier", "quality_alert_flag",
        "actual_line_items_per_txn_ratio", "duplicate_line_item_pct", "profile_created_at", "source_system", "grain_level",
    )


@query("agg3_intermediate_profile")
def agg3(spark, sf):
    lines = Warehouse(spark, sf, whole=True, by_transaction=True).refined_lines().select(*[n for n in profiles.INTERMEDIATE_COLUMNS if n != "line_item_key"])
    # The line's key, a hash that does not compress, is made from its parts where it is read.
    stored = materialise(lines, "lines").withColumn("line_item_key", flags.surrogate_key(c("transaction_id"), c("product_id")))
    return profiles.intermediate_profile(stored)


@query("agg4_intermediate_grades")
def agg4(spark, sf):
    return profiles.grade_intermediate(agg3(spark, sf)).select(
        "profile_date", "deduplication_status", "transaction_size_health", "health_status", "quality_tier", "refund_health",
        "promotion_intensity", "quality_alert_flag", "deduplication_success_pct", "profile_created_at", "entity_type", "grain_level",
    )


@query("agg5_conditional_counts")
def agg5(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_linestatus").agg(
        profiles.count_if(c("l_returnflag") == "R").alias("returned"), F.count_if(c("l_discount") > 0).alias("discounted"),
        F.count("*").alias("lines"),
    )


@query("agg6_count_distinct")
def agg6(spark, sf):
    part = F.coalesce(F.nullif(c("product_id"), F.lit("")), F.lit(""))
    return standin.raw_transactions(spark, sf).groupBy("store_id").agg(
        F.countDistinct("transaction_id").alias("transactions"), F.countDistinct("customer_id").alias("customers"),
        F.countDistinct(F.concat("transaction_id", F.lit("|"), part)).alias("pairs"),
    )


@query("agg7_safe_ratio")
def agg7(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("n"), profiles.count_if(c("l_returnflag") == "R").alias("returned"),
        profiles.count_if((c("l_returnflag") == "R") & (c("l_discount") > 0.05)).alias("deep"),
    )
    return lines.select(
        "l_suppkey", money_total(profiles.percent(c("deep"), c("returned"))).alias("deep_pct"),
        money_total(profiles.clamped_score([profiles.percent(c("returned"), c("n")) * 3.0])).alias("score"),
    )


@query("agg8_dimension_counts")
def agg8(spark, sf):
    wh = Warehouse(spark, sf)
    dims = {f"dim_{n}": wh.dim(n) for n in ("customers", "products", "stores")}
    return profiles.dimension_counts({**dims, "dim_date": wh.dim_date()})


@query("agg9_fact_statistics")
def agg9(spark, sf):
    return profiles.fact_statistics(Warehouse(spark, sf).fact())


def _orphans(wh):
    lines = wh.intmd_transactions().select("line_item_key", "customer_id", "product_id", "store_id")
    return profiles.orphan_counts(marts.star_lookup(lines, wh.dim("customers"), wh.dim("products"), wh.dim("stores")))


def _fact_and_orphans(wh):
    """What statistics and metrics read of the fact, stored, and its orphans: the lines are looked up once for both."""
    keys = {d: f"{d}_key" for d in ("customer", "product", "store")}
    fact = materialise(
        marts.sold_lines(wh.looked_up(), wh.ctx, [c(k).isNotNull().alias(f"known_{d}") for d, k in keys.items()]).select(
            "transaction_date", "is_refund", "line_total", "line_profit", "line_profit_margin_pct", *keys.values(), *[f"known_{d}" for d in keys]
        ), "fact",
    )
    return fact, profiles.orphan_counts(fact.select(*[F.when(c(f"known_{d}"), c(k)).alias(k) for d, k in keys.items()]))


@query("agg10_orphan_counts")
def agg10(spark, sf):
    return _orphans(Warehouse(spark, sf))


@query("agg11_gold_metrics")
def agg11(spark, sf):
    counts = agg8(spark, sf)
    fact, orphans = _fact_and_orphans(Warehouse(spark, sf))
    gate = profiles.gold_gate(counts, profiles.fact_statistics(fact), orphans)
    return profiles.gold_metrics(counts, fact, orphans, gate)


@query("agg12_daily_revenue")
def agg12(spark, sf):
    return reports.daily_revenue(Warehouse(spark, sf).sales())


@query("agg13_store_month_revenue")
def agg13(spark, sf):
    return reports.store_month_revenue(Warehouse(spark, sf).sales())


@query("agg14_top_categories")
def agg14(spark, sf):
    return reports.top_categories(Warehouse(spark, sf).sales())


@query("agg15_having_duplicates")
def agg15(spark, sf):
    lines = standin.raw_transactions(spark, sf).select(text.strip_dup_marker(c("transaction_id")).alias("transaction_id_clean"), "product_id")
    return reports.duplicate_groups(lines, ["transaction_id_clean", "product_id"])


@query("agg16_payment_share")
def agg16(spark, sf):
    out = reports.payment_shares(table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "payment_method"))
    return out.select("payment_method", money_total(c("percentage"), 4).alias("percentage"))


def _live_lines(spark, sf):
    """The live lines as a stored table: marked copies and re-sent lines removed."""
    live = streams.coerce_types(streams.parse_messages(standin.live_messages(spark, sf).drop("ts")))
    once = streams.drop_marked_duplicates(live).dropDuplicates(["transaction_id", "product_id"])
    return streams.enrich_with_stores(once, standin.live_stores(spark, sf))


@query("agg17_transaction_rollup")
def agg17(spark, sf):
    flat = streams.flatten_items(standin.nested_transactions(spark, sf))
    return reports.transaction_rollup(flat)


@query("agg18_live_totals")
def agg18(spark, sf):
    return reports.live_totals(reports.transaction_rollup(_live_lines(spark, sf)))


@query("agg18_live_store_metrics")
def agg18_stores(spark, sf):
    return reports.live_store_metrics(reports.transaction_rollup(_live_lines(spark, sf)))


@query("agg19_payment_breakdown")
def agg19(spark, sf):
    return reports.payment_breakdown(standin.nested_transactions(spark, sf))


@query("agg20_category_breakdown")
def agg20(spark, sf):
    return reports.category_breakdown(standin.nested_transactions(spark, sf))


@query("agg21_top_products")
def agg21(spark, sf):
    return reports.top_products(standin.nested_transactions(spark, sf))


@query("agg22_daily_summary")
def agg22(spark, sf):
    return reports.daily_summary(standin.nested_transactions(spark, sf))


# ---- windows -------------------------------------------------------------

@query("win1_dedup_latest_line")
def win1(spark, sf):
    return dedup.latest_line(Warehouse(spark, sf).stg_transactions()).select(
        "transaction_id_clean", "product_id", "transaction_id_raw", "staging_processed_at", "quantity"
    )


@query("win2_first_line")
def win2(spark, sf):
    lines = Warehouse(spark, sf).stg_transactions()
    order = [c("product_id").asc_nulls_last(), c("transaction_id_raw").asc(), c("total_amount").asc()]
    return dedup.first_line_per_transaction(lines, "transaction_id_clean", order).select("transaction_id_clean", "product_id", "total_amount")


@query("win3_occurrences")
def win3(spark, sf):
    lines = standin.raw_transactions(spark, sf).select(
        text.strip_dup_marker(c("transaction_id")).alias("transaction_id_clean"), "product_id", "transaction_id"
    )
    return dedup.occurrences(lines, ["transaction_id_clean", "product_id"])


@query("win4_share_of_total")
def win4(spark, sf):
    counted = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    return ranking.share_of_total(counted, "n", "pct").select("l_suppkey", "n", money_total(c("pct"), 4).alias("pct"))


def _order_days(spark, sf):
    daily = table(spark, sf, "orders").groupBy(c("o_orderdate").cast("date").alias("date")).agg(
        (F.sum(cents(c("o_totalprice"))) / 100.0).alias("revenue"), F.count("*").alias("orders")
    )
    return marts.with_missing_days(daily)


@query("win5_day_change")
def win5(spark, sf):
    return _order_days(spark, sf).select(
        "date", money_total(ranking.day_change("revenue", "date", 1)).alias("change_1"), money_total(ranking.day_change("revenue", "date", 7)).alias("change_7")
    )


@query("win6_rolling_mean")
def win6(spark, sf):
    return _order_days(spark, sf).select(
        "date", money_total(ranking.rolling_mean("revenue", "date", 7)).alias("mean_7"), money_total(ranking.rolling_mean("revenue", "date", 30)).alias("mean_30")
    )


@query("win7_to_date_totals")
def win7(spark, sf):
    days = _order_days(spark, sf).withColumn("y", F.year("date")).withColumn("m", F.month("date"))
    return days.select(
        "date", money_total(ranking.running_total("revenue", "date", "y", "m")).alias("mtd"), money_total(ranking.running_total("revenue", "date", "y")).alias("ytd")
    )


def _part_revenue(spark, sf):
    """Revenue per part in cents, one row per part."""
    sold = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.sum(cents(c("l_extendedprice"))).alias("revenue_cents"), F.sum(c("l_quantity").cast("bigint")).alias("units")
    )
    parts = table(spark, sf, "part").select(c("p_partkey").alias("l_partkey"), "p_type")
    return materialise(sold.join(parts, "l_partkey"), "part-revenue")


@query("win8_global_ranks")
def win8(spark, sf):
    ranked = ranking.global_ranks(_part_revenue(spark, sf), {"revenue_cents": "revenue_rank", "units": "units_rank"}, materialise)
    return ranking.rank_in_group(ranked, "p_type", "revenue_cents", "rank_in_type", materialise)


@query("win8_global_ranks_in_ranges")
def win8_ranges(spark, sf):
    """The same, forced through the path for inputs too large for one task."""
    base = _part_revenue(spark, sf)
    ranked = ranking.global_ranks(
        base, {"revenue_cents": "revenue_rank", "units": "units_rank"}, materialise, ranges=9
    )
    return ranking.rank_in_group(ranked, "p_type", "revenue_cents", "rank_in_type", materialise, ranges=9)


@query("win9_percentile_tiers")
def win9(spark, sf):
    base = _part_revenue(spark, sf)
    ranked = ranking.global_ranks(base, {"revenue_cents": "revenue_rank"}, materialise)
    counted = ranked.crossJoin(F.broadcast(base.agg(F.count("*").alias("_n"))))
    pct = (c("revenue_rank") - 1).cast("double") / F.greatest(c("_n") - 1, F.lit(1)).cast("double")
    tier = F.when(c("revenue_rank") <= 10, "Top 10").when(pct <= 0.2, "Top 20%").when(pct <= 0.5, "Top 50%").otherwise("Bottom 50%")
    return counted.select("l_partkey", money_total(pct, 4).alias("percent_rank"), tier.alias("performance_tier"))


@query("win10_abc_class")
def win10(spark, sf):
    from tillhouse.functions.buckets import ladder

    shares = ranking.running_share(_part_revenue(spark, sf), "revenue_cents", "share", materialise)
    return shares.select("l_partkey", money_total(c("share"), 6).alias("share"), ladder(c("share"), marts.ABC, "C - Low Products").alias("abc_class"))


# ---- sort, set, generate ---------------------------------------------------

@query("srt1_order_by")
def srt1(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(c("o_totalprice").desc(), "o_orderkey")


@query("srt2_top_k")
def srt2(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(c("o_totalprice").desc(), "o_orderkey").limit(25)


@query("set1_union_all")
def set1(spark, sf):
    names = [("customer", "c_name", "c_acctbal"), ("supplier", "s_name", "s_acctbal")]
    a, b = [table(spark, sf, t).select(F.lit(t).alias("kind"), c(n).alias("name"), c(v).alias("balance")) for t, n, v in names]
    return a.unionByName(b)


@query("set2_distinct")
def set2(spark, sf):
    return table(spark, sf, "part").select(text.strip_non_printable(c("p_name")).alias("name"), "p_brand").distinct()


@query("gen1_date_spine")
def gen1(spark, sf):
    spine = marts.date_spine(spark, marts.CALENDAR_START, marts.CALENDAR_END)
    daily = table(spark, sf, "events").groupBy(c("ts").cast("date").alias("date_day")).agg(F.count("*").alias("events"))
    return spine.join(daily, "date_day", "left").select("date_day", F.coalesce("events", F.lit(0)).alias("events"))


@query("gen2_date_series")
def gen2(spark, sf):
    """Orders of each day: 2,500 days from 1995 on, and all days before or after that the orders reach."""
    ordered = table(spark, sf, "orders").select(c("o_orderdate").cast("date").alias("expected_date"))
    days = marts.date_series(spark, *marts.widened(dt.date(1995, 1, 1), 2500, ordered))
    daily = ordered.groupBy("expected_date").agg(F.count("*").alias("orders"))
    return days.join(daily, "expected_date", "left").select("expected_date", F.coalesce("orders", F.lit(0)).alias("orders"))


# ---- dimensions, fact, marts -------------------------------------------------

@query("dim1_calendar")
def dim1(spark, sf):
    """The calendar over the days the orders span."""
    edge = table(spark, sf, "orders").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    return marts.dim_date(edge.select(F.explode(F.sequence(F.trunc("a", "year"), F.date_add("b", 400))).alias("date_day")))


@query("dim2_customers")
def dim2(spark, sf):
    return Warehouse(spark, sf).dim("customers")


@query("dim3_products")
def dim3(spark, sf):
    return Warehouse(spark, sf).dim("products")


@query("dim4_stores")
def dim4(spark, sf):
    return Warehouse(spark, sf).dim("stores")


@query("fct1_fact_sales")
def fct1(spark, sf):
    amounts = ["net_amount", "gross_amount", "total_cost", "line_profit", "line_profit_margin_pct", "line_total", "discount_amount"]
    return Warehouse(spark, sf, whole=True).fact().withColumns({a: money(c(a), 4) for a in amounts})


@query("mrt1_revenue_performance")
def mrt1(spark, sf):
    return marts.revenue_performance(Warehouse(spark, sf).fact())


@query("mrt2_store_performance")
def mrt2(spark, sf):
    wh = Warehouse(spark, sf)
    return marts.store_performance(wh.fact(), wh.dim("stores"))


@query("mrt3_products_performance")
def mrt3(spark, sf):
    wh = Warehouse(spark, sf, by_transaction=True)
    return marts.products_performance(wh.fact(), wh.dim("products"))


@query("mrt4_customer_metrics")
def mrt4(spark, sf):
    wh = Warehouse(spark, sf, by_transaction=True)
    return marts.customer_metrics(wh.fact(), wh.dim("customers"))


@query("mrt5_revenue_consistency")
def mrt5(spark, sf):
    wh = Warehouse(spark, sf)
    # Both marts read sales only: refunds need not be looked up and stored for them.
    fact = materialise(wh.fact().where("not is_refund").select(
        "transaction_date", "line_total", "total_cost", "line_profit", "transaction_id", "customer_key", "store_key", "quantity", "is_refund"
    ), "fact")
    return marts.revenue_consistency(marts.revenue_performance(fact), marts.store_performance(fact, wh.dim("stores")))


# ---- gates -------------------------------------------------------------------

@query("gat1_staging_gate")
def gat1(spark, sf):
    return profiles.staging_gate(profiles.grade_staging(agg1(spark, sf)))


@query("gat2_intermediate_gate")
def gat2(spark, sf):
    return profiles.intermediate_gate(profiles.grade_intermediate(agg3(spark, sf)))


@query("gat3_gold_gate")
def gat3(spark, sf):
    fact, orphans = _fact_and_orphans(Warehouse(spark, sf))
    return profiles.gold_gate(agg8(spark, sf), profiles.fact_statistics(fact), orphans)


# ---- incremental ----------------------------------------------------------------

@query("inc1_hash_capture")
def inc1(spark, sf):
    first, second = Warehouse(spark, sf).dim_batches("products")
    from tillhouse.functions.flags import row_hash

    def hashed(df):
        return df.select("product_id", "supplier", row_hash(c("product_id"), c("supplier"), c("category")).alias("_row_hash")).distinct()

    return incremental.hash_changes(hashed(second), hashed(first), "product_id")


@query("inc2_watermark_capture")
def inc2(spark, sf):
    lines = Warehouse(spark, sf).stg_transactions().select("transaction_id_raw", "product_id", "raw_loaded_at", "staging_processed_at")
    held = lines.where(c("staging_processed_at") < F.lit(str(CUT)).cast("timestamp_ntz"))
    return incremental.newer_than(lines, "raw_loaded_at", incremental.high_water_mark(held, "staging_processed_at"))


@query("inc3_upsert_by_key")
def inc3(spark, sf):
    from tillhouse.sources.sinks import upserted

    lines = Warehouse(spark, sf).stg_transactions().select("transaction_id_clean", "product_id", "transaction_id_raw", "staging_processed_at", "quantity")
    before = c("staging_processed_at") < F.lit(str(CUT)).cast("timestamp_ntz")
    return upserted(lines.where(before), lines.where(~before), ["transaction_id_clean", "product_id"])


@query("inc4_profile_upsert")
def inc4(spark, sf):
    from tillhouse.sources.sinks import upserted

    profile = agg1(spark, sf).select("profile_date", "total_line_items", "unique_transactions")
    profile = materialise(profile, "profile")
    held = profile.where(c("profile_date") < F.lit(str(CUT)).cast("timestamp_ntz")).withColumn("unique_transactions", F.lit(0).cast("bigint"))
    batch = incremental.new_profile_days(profile, held)
    return upserted(held, batch, ["profile_date"])


@query("scd1_initial_load")
def scd1(spark, sf):
    return marts.load_dimension("stores", Warehouse(spark, sf).intmd_stores(), FIRST_RUN)


@query("scd2_customers_two_batches")
def scd2_customers(spark, sf):
    return Warehouse(spark, sf).merged_dim("customers")


@query("scd2_products_two_batches")
def scd2_products(spark, sf):
    return Warehouse(spark, sf).merged_dim("products")


@query("scd2_stores_two_batches")
def scd2_stores(spark, sf):
    return Warehouse(spark, sf).merged_dim("stores")


@query("scd2_stored_in_parts")
def scd2_stored(spark, sf):
    """Both batches of the customers taken by the stored dimension, with one bucket per 500 of them."""
    dim = Dimension(spark, f"{shared_folder(spark)}/dimension-{uuid.uuid4().hex}", *marts.DIMENSIONS["customers"], bucket_rows=500)
    for batch, ctx in zip(Warehouse(spark, sf).dim_batches("customers"), (FIRST_RUN, CTX)):
        dim.take(batch, ctx.now)
    return dim.versions()


@query("scd3_current_view")
def scd3(spark, sf):
    return scd.current(Warehouse(spark, sf).merged_dim("products")).select("product_id", "product_key", "supplier", "valid_start_date")


