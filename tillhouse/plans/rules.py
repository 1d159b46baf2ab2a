"""Checks that return the failing rows (DQ14-DQ27).

A rule states what must hold in its own terms; it does not call the function that built the column it checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.context import DEFAULT, RunContext
from tillhouse.functions import buckets, measures, text
from tillhouse.operators.quality import duplicate_keys
from tillhouse.plans.marts import date_series
from tillhouse.plans.reports import payment_shares

c = F.col


def profit_mismatch(fact: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """DQ14: profit differs from revenue minus cost."""
    computed = c("line_total") - c("total_cost")
    scope = (c("total_cost") > 0) & (c("line_total") != 0) & ~c("is_refund")
    return fact.where(scope).select(
        "sales_key", "transaction_id", "product_key", "line_total", "total_cost", "line_profit",
        computed.alias("calculated_profit"), F.abs(c("line_profit") - computed).alias("difference"),
        F.lit("Profit calculation mismatch!").alias("error_message"),
    ).where(c("difference") > tolerance)


def non_positive_sales(fact: DataFrame) -> DataFrame:
    """DQ15: sales with a non-positive total, quantity or price, and which."""
    reason = (
        F.when(c("line_total") <= 0, "Line total should be positive").when(c("quantity") <= 0, "Quantity should be positive")
        .when(c("unit_price") <= 0, "Unit price should be positive")
    )
    return fact.where("not is_refund").select(
        "sales_key", "transaction_id", "product_key", "customer_key", "is_refund", "quantity", "unit_price", "line_total",
        reason.alias("error_reason"),
    ).where(c("error_reason").isNotNull())


def calendar_gaps(calendar: DataFrame, start, days: int) -> DataFrame:
    """DQ16: expected days the calendar lacks."""
    expected = date_series(calendar.sparkSession, start, days)
    held = calendar.select(c("date_actual").alias("expected_date"))
    return expected.join(held, "expected_date", "left_anti").withColumn("error_message", F.lit("MISSING DATE!"))


def total_mismatch(lines: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """DQ18: subtotal plus tax is not the total."""
    diff = measures.money(F.abs(c("subtotal") + c("tax_amount") - c("total_amount")))
    return lines.select("transaction_id_clean", "subtotal", "tax_amount", "total_amount", diff.alias("difference")).where(c("difference") > tolerance)


def refunds_without_reason(lines: DataFrame) -> DataFrame:
    """DQ19: the status is compared in the staged spelling."""
    return lines.where((c("payment_status") == "REFUNDED") & text.blank(c("refund_reason"))).select(
        "transaction_id_clean", "payment_status", "refund_reason"
    )


def unusual_payment_shares(lines: DataFrame, low: float = 1.0, high: float = 80.0) -> DataFrame:
    """DQ20: payment methods with a share outside the usual band."""
    return payment_shares(lines).where((c("percentage") < low) | (c("percentage") > high))


def flag_disagreements(lines: DataFrame) -> DataFrame:
    """DQ22: a flag does not follow from its source column."""
    tests = {
        "has_promotion": c("has_promotion") != F.coalesce(F.length(F.trim("promotion_code")) > 0, F.lit(False)),
        "is_refund": c("is_refund") != ((c("payment_status") == "REFUNDED") | c("refund_reason").isNotNull()),
        "is_weekend": c("is_weekend") != F.date_format("transaction_date", "E").isin("Sat", "Sun"),
    }
    held = {k: v for k, v in tests.items() if k in lines.columns}
    which = F.array_compact(F.array(*[F.when(v, k) for k, v in held.items()]))
    return lines.select("transaction_id", "product_id", which.alias("flags")).where(F.size("flags") > 0).select(
        "transaction_id", "product_id", F.array_join("flags", ",").alias("flags")
    )


def discount_mismatch(lines: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """DQ23: the stored discount is not that share of the full price."""
    again = c("quantity") * c("unit_price") * c("discount_percent") / 100
    return lines.where(F.abs(c("discount_amount") - again) > tolerance).select("transaction_id_raw", "product_id", "discount_amount")


def age_mismatch(customers: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """DQ23: the stored age and the age in completed years differ."""
    day = lambda d: F.year(d) * 10000 + F.month(d) * 100 + F.day(d)
    completed = F.floor((day(ctx.today) - day(c("date_of_birth"))) / 10000).cast("int")
    return customers.where(c("age") != completed).select("customer_id", "age", completed.alias("completed_years"))


def margin_mismatch(products: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """DQ23: the margin from the rounded prices differs from the stored one."""
    priced = (c("selling_price") > 0) & (c("cost_price") >= 0)
    again = F.when(priced, measures.money(100 - c("cost_price") / F.nullif(c("selling_price"), F.lit(0.0)) * 100))
    return products.where(F.abs(c("profit_margin_pct") - again) > tolerance).select("product_id", "profit_margin_pct", again.alias("recomputed"))


def years_mismatch(stores: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """DQ23: rounded years against days / 365."""
    years = c("days_since_opening") / 365.0
    return stores.where(F.abs(c("years_since_opening") - years) > tolerance).select("store_id", "years_since_opening", "days_since_opening")


def clean_total_mismatch(lines: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """DQ23: a cleaned total that is neither the raw one nor a correction of it.

    Wrong are a sale's loss that is not put to 0, a zero total of priced goods that is not their price less the
    discount, and any other total that is not the raw one.
    """
    total, clean, priced = c("line_total"), c("line_total_clean"), (c("quantity") > 0) & (c("unit_price") > 0)
    full = c("quantity") * c("unit_price")
    loss = (total < 0) & ~c("is_refund")
    wrong = (
        (loss & (clean != 0))
        | ((total == 0) & priced & (F.abs(clean + full * c("discount_percent") / 100 - full) > tolerance))
        | (~loss & ~((total == 0) & priced) & (F.abs(clean - total) > tolerance))
    )
    return lines.where(wrong).select("line_item_key", "line_total", "line_total_clean")


def positive_refunds(lines: DataFrame) -> DataFrame:
    """DQ24: refunds that add revenue."""
    return lines.where(c("is_refund") & (c("line_total_clean") > 0)).select("line_item_key", "line_total_clean")


def repeated_emails(customers: DataFrame) -> DataFrame:
    """DQ25."""
    return duplicate_keys(customers, ["email"])


def repeated_store_names(stores: DataFrame) -> DataFrame:
    """DQ25: within a city."""
    return duplicate_keys(stores, ["store_name", "city"])


def label_disagreements(customers: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """DQ26: labels that do not follow from their measure."""
    def failing(df: DataFrame, key: str, label: str, expected) -> DataFrame:
        return df.where(~c(label).eqNullSafe(expected)).select(
            c(key).alias("id"), F.lit(label).alias("label"), c(label).alias("stored"), expected.alias("expected")
        )

    zip_state = F.coalesce("state_name_from_zip", c("state"))
    issues, kg = c("quality_issues_count"), c("weight")
    by_issues = F.when(issues > 2, "POOR").when(issues > 0, "ACCEPTABLE").otherwise("CLEAN")
    by_weight = (
        F.when(kg.isNull(), "Unknown").when(kg > 25, "Very Heavy (25+ kg)").when(kg > 5, "Heavy (5-25 kg)")
        .when(kg >= 1, "Medium (1-5 kg)").otherwise("Light (< 1 kg)")
    )
    return (
        failing(customers, "customer_id", "state", zip_state)
        .unionByName(failing(customers, "customer_id", "quality_tier", by_issues))
        .unionByName(failing(products, "product_id", "weight_category", by_weight))
        .unionByName(failing(stores, "store_id", "region", buckets.region(c("state"))))
        .unionByName(failing(stores, "store_id", "store_category", buckets.store_category(c("store_type"))))
    )


def domain_violations(products: DataFrame, stores: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """DQ27: staged rows outside their domain."""
    stock = c("stock_quantity_raw")
    goods = {
        "cost_exceeds_price": c("cost_price") > c("selling_price"),
        "negative_stock": stock < 0,
        "stock_flags_overlap": (c("zero_stock_quantity_flag") + c("is_low_stock") + c("negative_stock_quantity_flag")) > 1,
    }
    parts = [products.where(t).select(c("product_id").alias("id"), F.lit(n).alias("violation")) for n, t in goods.items()]
    parts.append(stores.where(c("opening_date") > ctx.today).select(c("store_id").alias("id"), F.lit("future_opening").alias("violation")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
