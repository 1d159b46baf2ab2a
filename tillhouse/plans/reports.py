"""Business reports over the fact and the till (AGG12-AGG22, SRT1-SRT2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.measures import money_total, revenue_sum
from tillhouse.operators.ranking import share_of_total


def daily_revenue(sales: DataFrame) -> DataFrame:
    """AGG12: revenue per day, best day first."""
    return (
        sales.groupBy("transaction_date").agg(revenue_sum("line_total").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "transaction_date")
    )


def store_month_revenue(sales: DataFrame) -> DataFrame:
    """AGG13: revenue per store and calendar month, best first."""
    return (
        sales.groupBy("store_name", "transaction_month").agg(revenue_sum("line_total").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "store_name", "transaction_month")
    )


def top_categories(sales: DataFrame, n: int = 10) -> DataFrame:
    """AGG14: the ``n`` best categories, refunds left out."""
    return (
        sales.where("not is_refund").groupBy("category").agg(revenue_sum("line_total").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "category").limit(n)
    )


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """AGG15: keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("duplicate_count")).where("duplicate_count > 1")


def payment_shares(df: DataFrame) -> DataFrame:
    """AGG16: percent of rows per payment method."""
    counted = df.groupBy("payment_method").agg(F.count("*").alias("n"))
    return share_of_total(counted, "n", "percentage").select("payment_method", "percentage")


def transaction_rollup(lines: DataFrame) -> DataFrame:
    """AGG17: one row per transaction.

    The header comes from one line, the one of the smallest product id, so it
    never mixes two lines; it travels as a single struct of the aggregation.
    """
    header = ["store_id", "date", "time", "datetime", "customer_id", "payment_method", "total_amount", "items_count", "status"]
    carried = [c for c in [*header, "store_name", "tax_amount", "subtotal"] if c in lines.columns]
    first = F.min_by(F.struct(*carried), F.struct("product_id", *[c for c in carried if c != "datetime"]))
    return (
        lines.groupBy("transaction_id")
        .agg(first.alias("h"), money_total(F.sum("line_total")).alias("line_total"), F.sum("quantity").alias("quantity"))
        .select("transaction_id", "h.*", "line_total", "quantity")
    )


def live_totals(transactions: DataFrame) -> DataFrame:
    """AGG18: the four headline figures."""
    return transactions.agg(
        F.count("*").alias("total_transactions"), money_total(F.sum("total_amount")).alias("total_revenue"),
        F.countDistinct("store_name").alias("active_stores"), money_total(F.avg("total_amount")).alias("avg_transaction"),
    )


def live_store_metrics(transactions: DataFrame) -> DataFrame:
    """AGG18 per store."""
    return transactions.groupBy("store_name").agg(
        money_total(F.sum("total_amount")).alias("total_sales"), F.count("*").alias("transactions"),
        money_total(F.avg("total_amount")).alias("avg_basket"), money_total(F.avg("items_count"), 1).alias("avg_items"),
    )


def payment_breakdown(transactions: DataFrame) -> DataFrame:
    """AGG19."""
    return transactions.groupBy(F.coalesce("payment_method", F.lit("Unknown")).alias("payment_method")).agg(F.count("*").alias("transactions"))


def sold_items(nested: DataFrame) -> DataFrame:
    """The items of nested transactions, one row each."""
    return nested.select(F.explode("items").alias("item")).select("item.*")


def category_breakdown(nested: DataFrame) -> DataFrame:
    """AGG20: units and revenue per category."""
    return sold_items(nested).groupBy(F.coalesce("category", F.lit("Unknown")).alias("category")).agg(
        F.sum(F.abs("quantity")).alias("count"), revenue_sum("line_total").alias("revenue")
    )


def top_products(nested: DataFrame, n: int = 10) -> DataFrame:
    """AGG21: best products by revenue, ties by id."""
    return (
        sold_items(nested).groupBy("product_id")
        .agg(F.min("product_name").alias("product_name"), F.sum(F.abs("quantity")).alias("quantity_sold"), revenue_sum("line_total").alias("revenue"))
        .orderBy(F.col("revenue").desc(), "product_id").limit(n)
    )


def daily_summary(nested: DataFrame) -> DataFrame:
    """AGG22: eleven figures per day; items are counted inside the row, without exploding it."""
    c = F.col
    negative = F.size(F.filter("items", lambda i: i["quantity"] < 0))
    return nested.groupBy("date").agg(
        F.count("*").alias("total_transactions"), money_total(F.sum("total_amount")).alias("total_revenue"),
        F.sum("items_count").alias("total_items_sold"), F.countDistinct("customer_id").alias("unique_customers"),
        F.count_if(c("transaction_id").contains("DUP")).alias("duplicate_transactions"),
        F.count_if(c("status") == "Failed").alias("failed_transactions"), F.count_if(c("status") == "Refunded").alias("refunded_transactions"),
        F.count_if(c("datetime").isNull()).alias("missing_timestamps"), F.count_if(c("cashier_id").isNull()).alias("missing_cashier_ids"),
        F.sum(negative.cast("bigint")).alias("negative_quantities"),
    )
