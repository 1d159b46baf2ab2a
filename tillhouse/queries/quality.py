"""DQ1-DQ27 and the full check suite of every table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tillhouse.context import DEFAULT as CTX
from tillhouse.operators import quality as q
from tillhouse.plans import marts, reports, rules, suites
from tillhouse.plans.inputs import Warehouse
from tillhouse.queries.registry import QUERIES, query
from tillhouse.session import materialise
from tillhouse.sources import standin
from tillhouse.sources.files import table

c = F.col


def _run(df, *checks, parents=None):
    return q.run_checks(df, list(checks), CTX.run_ts, parents)


@query("dq1_not_null")
def dq1(spark, sf):
    return _run(standin.raw_transactions(spark, sf), q.not_null("customer_id"), q.not_null("date").warn(), q.not_null("product_id").warn(1000), q.not_null("store_id"))


@query("dq2_unique")
def dq2(spark, sf):
    return _run(standin.raw_products(spark, sf), q.unique("product_id"), q.unique("sku").warn())


@query("dq3_unique_combination")
def dq3(spark, sf):
    return _run(table(spark, sf, "lineitem"), q.unique("l_orderkey", "l_linenumber"), q.unique("l_orderkey", "l_partkey").warn(10))


@query("dq4_accepted_values")
def dq4(spark, sf):
    return _run(
        standin.raw_customers(spark, sf), q.accepted_values("gender", ["Male", "Female", "Other"]).warn(),
        q.accepted_values("loyalty_member", [True, False]), q.accepted_values("state", ["NATION_1", "NATION_2"], "state is not null"),
    )


@query("dq5_accepted_range")
def dq5(spark, sf):
    return _run(
        table(spark, sf, "lineitem"), q.accepted_range("l_quantity", 1, 45), q.accepted_range("l_extendedprice", high=100000).warn(),
        q.accepted_range("l_discount", 0.01, where="l_returnflag = 'R'"),
    )


@query("dq6_expression")
def dq6(spark, sf):
    return _run(
        table(spark, sf, "orders"), q.expression("o_totalprice", "> 1000"), q.expression("o_orderdate", ">= timestamp_ntz'1996-01-01 00:00:00'", "o_orderstatus = 'F'").warn(),
    )


@query("dq7_relationships")
def dq7(spark, sf):
    parent = Warehouse(spark, sf).stg_products()
    lines = standin.raw_transactions(spark, sf).select("product_id")
    return _run(lines, q.foreign_key("product_id", "stg_products", "product_id").warn(), parents={"stg_products": parent})


@query("dq8_not_empty_string")
def dq8(spark, sf):
    return _run(standin.raw_customers(spark, sf), q.not_empty_string("email"), q.not_empty_string("city").warn(), q.not_empty_string("zip_code"))


@query("dq9_recency")
def dq9(spark, sf):
    return _run(table(spark, sf, "lineitem"), q.recency("l_shipdate", 100), q.recency("l_shipdate", 2).warn())


@query("dq10_match_regex")
def dq10(spark, sf):
    return _run(standin.raw_customers(spark, sf), q.match_regex("email", suites.EMAIL).warn(50))


@query("dq11_value_length")
def dq11(spark, sf):
    return _run(table(spark, sf, "documents"), q.value_length("lang", 2, 2), q.value_length("text", 50, 5000).warn(5), q.value_length("source", 4, 4, "lang = 'en'"))


@query("dq12_freshness")
def dq12(spark, sf):
    return q.freshness(table(spark, sf, "orders"), "o_orderdate", dt.datetime(2001, 8, 2, 12), 24, 48)


@query("dq13_severity_and_thresholds")
def dq13(spark, sf):
    from dataclasses import replace

    base = q.accepted_range("l_quantity", 1, 45)
    variants = [("strict", {}), ("lenient", {"error_above": 10**9}), ("silent", {"severity": "warn", "warn_above": 10**9})]
    return _run(table(spark, sf, "lineitem"), *[replace(base, name=n, **v) for n, v in variants])


@query("dq14_profit_identity")
def dq14(spark, sf):
    return rules.profit_mismatch(Warehouse(spark, sf).fact()).select("sales_key", "product_key", "error_message")


@query("dq15_positive_sales")
def dq15(spark, sf):
    return rules.non_positive_sales(Warehouse(spark, sf).fact()).select("sales_key", "quantity", "unit_price", "error_reason")


@query("dq16_calendar_gaps")
def dq16(spark, sf):
    """Days without an order, from 1995-01-01 to 2001-07-31 and as far before or after as the orders reach, against the calendar built from them."""
    days = table(spark, sf, "orders").select(c("o_orderdate").cast("date").alias("date_day")).distinct()
    return rules.calendar_gaps(marts.dim_date(days).select("date_actual"), *marts.widened(dt.date(1995, 1, 1), 2404, days))


@query("dq17_duplicate_lines")
def dq17(spark, sf):
    lines = Warehouse(spark, sf).stg_transactions().select("transaction_id_clean", "product_id")
    return reports.duplicate_groups(lines, ["transaction_id_clean", "product_id"])


@query("dq18_transaction_math")
def dq18(spark, sf):
    return rules.total_mismatch(Warehouse(spark, sf).stg_transactions()).select("transaction_id_clean", "total_amount", "difference")


@query("dq19_refund_reason")
def dq19(spark, sf):
    return rules.refunds_without_reason(Warehouse(spark, sf).stg_transactions())


@query("dq20_payment_share_band")
def dq20(spark, sf):
    out = rules.unusual_payment_shares(table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "payment_method"), 20.0, 80.0)
    return out.select("payment_method")


@query("dq21_composite_key")
def dq21(spark, sf):
    return _run(Warehouse(spark, sf).intmd_transactions(), q.unique("transaction_id", "product_id"), q.unique("line_item_key"))


@query("dq22_flags_agree")
def dq22(spark, sf):
    return rules.flag_disagreements(Warehouse(spark, sf).intmd_transactions())


@query("dq23_discount_recomputed")
def dq23_discount(spark, sf):
    return rules.discount_mismatch(Warehouse(spark, sf).stg_transactions())


@query("dq23_age_recomputed")
def dq23_age(spark, sf):
    return rules.age_mismatch(Warehouse(spark, sf).stg_customers())


@query("dq23_margin_recomputed")
def dq23_margin(spark, sf):
    return rules.margin_mismatch(Warehouse(spark, sf).stg_products(), 0.0)


@query("dq23_years_recomputed")
def dq23_years(spark, sf):
    return rules.years_mismatch(Warehouse(spark, sf).stg_stores(), 0.4)


@query("dq23_line_total_recomputed")
def dq23_total(spark, sf):
    return rules.clean_total_mismatch(Warehouse(spark, sf).intmd_transactions()).select("line_item_key")


@query("dq24_positive_refunds")
def dq24(spark, sf):
    return rules.positive_refunds(Warehouse(spark, sf).intmd_transactions())


@query("dq25_email_unique")
def dq25_email(spark, sf):
    return rules.repeated_emails(Warehouse(spark, sf).stg_customers())


@query("dq25_store_name_unique_in_city")
def dq25_store(spark, sf):
    return rules.repeated_store_names(Warehouse(spark, sf).stg_stores())


@query("dq26_labels_agree")
def dq26(spark, sf):
    wh = Warehouse(spark, sf)
    return rules.label_disagreements(wh.intmd_customers(), wh.stg_products(), wh.intmd_stores())


@query("dq27_domain")
def dq27(spark, sf):
    wh = Warehouse(spark, sf)
    return rules.domain_violations(wh.stg_products(), wh.stg_stores())


def _suite(name):
    def run(spark, sf):
        wh = Warehouse(spark, sf, whole=name in ("stg_transactions", "intmd_transactions"), by_transaction=name in ("customer_metrics", "products_performance"))
        parents = {p: wh.table(p) for p in suites.parent_tables(name)}
        df = wh.table(name)
        checks = suites.suite(name)
        if any(k.kind != "row" for k in checks):
            df = materialise(df.select(*q.columns_read(df, checks)), f"suite-{name}")
        return q.run_checks(df, checks, CTX.run_ts, parents)

    return run


for _name in suites.SUITES:
    if _name != "dim_date":
        QUERIES[f"suite_{_name}"] = _suite(_name)
