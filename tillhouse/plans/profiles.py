"""Daily quality profiles and the gates that read them (AGG1-AGG7, GAT1-GAT3).

Each profile is put together from narrow aggregations added up by day.  Counts per
key and the first line of a transaction are aggregated, never windowed over
whole groups, so a hot transaction or product does not land in one task.
Averages and money totals are rounded to four places: the result must not
depend on the order in which partitions are added up.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillhouse.context import DEFAULT, RunContext
from tillhouse.functions.buckets import ladder
from tillhouse.functions.flags import packed_key
from tillhouse.functions.measures import exact_sum, money_total, revenue_sum
from tillhouse.operators.dedup import first_line_per_transaction

# Grades of the profiles and limits of the gates.
STAGING_HEALTH = [(">=", 95, "Excellent"), (">=", 90, "Good"), (">=", 80, "Fair"), (">=", 70, "Poor")]
INTERMEDIATE_HEALTH = [(">=", 98, "Excellent"), (">=", 95, "Good"), (">=", 90, "Fair")]
CLEAN_TIERS = [(">=", 95, "HIGH_QUALITY"), (">=", 90, "GOOD_QUALITY"), (">=", 85, "ACCEPTABLE_QUALITY")]
REFUND_HEALTH = [(">", 10, "HIGH_REFUNDS"), (">", 5, "ELEVATED_REFUNDS")]
PROMOTIONS = [(">", 40, "HEAVY_PROMOTIONS"), (">", 20, "MODERATE_PROMOTIONS")]
BASKETS = [("<", 1.5, "Low - Few Multi-Item Transactions"), ("<=", 3.0, "Healthy - Normal Distribution")]
STAGING_MIN_SCORE = 70.0
INTERMEDIATE_LIMITS = {"dedup_pct": 100.0, "min_score": 90.0, "min_clean": 70.0, "max_refund": 10.0, "min_items": 1.5, "max_items": 3.0}
GOLD_LIMITS = {"customers": 1000, "products": 100, "stores": 10, "sales": 1000, "calendar": 4018, "orphans": 100, "stale_days": 7}

STAGING_COLUMNS = [
    "staging_processed_at", "transaction_date", "transaction_id_clean", "transaction_id_raw", "product_id", "customer_id",
    "store_id", "missing_transaction_id_flag", "missing_date_flag", "missing_customer_id_flag", "missing_product_id_flag",
    "negative_quantity_flag", "negative_amount_flag", "zero_total_amount_flag", "zero_quantity_flag",
    "high_unit_price_flag", "line_total", "quantity", "total_amount", "is_refund", "has_promotion",
]
INTERMEDIATE_COLUMNS = [
    "intermediate_processed_at", "line_item_key", "transaction_id", "customer_id", "product_id", "store_id",
    "data_quality_status", "line_total_clean", "quantity_clean", "total_amount", "is_refund", "has_promotion",
    "has_discount", "is_bulk_purchase", "is_high_value_item", "transaction_type", "is_weekend", "time_of_day",
    "discount_percent", "discount_amount", "payment_method", "earned_loyalty_points", "loyalty_points_earned",
]


def count_if(test: Column) -> Column:
    """AGG5: rows for which the test holds."""
    return F.sum(F.when(test, 1).otherwise(0))


def percent(part: Column, whole: Column) -> Column:
    """AGG7: unrounded percentage, NULL for an empty whole."""
    return part.cast("double") * 100.0 / F.nullif(whole.cast("double"), F.lit(0.0))


def clamped_score(penalties: list[Column]) -> Column:
    """AGG7: 100 minus the penalties, never below zero."""
    score = F.lit(100.0)
    for p in penalties:
        score = score - p
    return F.greatest(F.lit(0.0), score)


class Layer:
    """What a profile counts: figures that add up over lines, over transactions, and distinct values per day.

    Lines carry ``w``, how often each counts: 1, or -1 for a line that has been replaced.  So the figures of a
    batch's changes can be added to those held (``plans/profile_state.py``).
    """

    name: str
    at: str  # its day is the profile's
    transaction: str
    columns: list[str]
    measures: list[str]
    distinct: dict[str, str]  # figure: column
    line: list[str]  # what tells lines apart where figures over transactions are concerned
    dated: str | None = None  # first and last day of this column are figures

    def counts(self) -> dict[str, Column]:
        """Figures that count lines, and the test of each."""
        raise NotImplementedError

    def per_transaction(self, lines: DataFrame) -> list[DataFrame]:
        """Figures by day that are sums over transactions."""
        raise NotImplementedError

    def finish(self, figures: DataFrame) -> DataFrame:
        """Averages, shares and the score."""
        raise NotImplementedError

    def weighted(self, lines: DataFrame, w: int = 1) -> DataFrame:
        """Lines of a stored table, with their day and weight."""
        day = F.date_trunc("day", self.at).cast("timestamp_ntz").alias("profile_date")
        return lines.select(day, *[c for c in self.columns if c != self.at], F.lit(w).cast("bigint").alias("w"))

    def sums(self, lines: DataFrame) -> DataFrame:
        """Figures that add up over lines."""
        def signed(m: str) -> Column:
            return F.sum(F.col(m).cast("decimal(28,8)") * F.col("w").cast("decimal(9,0)")).cast("decimal(38,8)")

        return lines.groupBy("profile_date").agg(
            F.sum("w").alias("total_line_items"), *[F.sum(F.when(test, F.col("w")).otherwise(0)).alias(k) for k, test in self.counts().items()],
            *[signed(m).alias(f"sum_{m}") for m in self.measures],
            *[F.sum(F.when(F.col(m).isNotNull(), F.col("w")).otherwise(0)).alias(f"n_{m}") for m in self.measures],
        )

    def references(self, lines: DataFrame) -> DataFrame:
        """``profile_date, kind, value, n``: how often each value stands on a day.  A scan of two columns per kind."""
        kinds = {*self.distinct.values(), *([self.dated] if self.dated else [])}
        parts = [
            lines.where(F.col(c).isNotNull()).groupBy("profile_date", F.col(c).cast("string").alias("value")).agg(F.sum("w").alias("n"))
            .select("profile_date", F.lit(c).alias("kind"), "value", "n") for c in sorted(kinds)
        ]
        return reduce(DataFrame.unionAll, parts)

    def distinct_figures(self, references: DataFrame) -> DataFrame:
        """Distinct values per day, and the first and last date, from references that are held at least once."""
        of = lambda c: F.col("kind") == c
        days = [f(F.when(of(self.dated), F.col("value").cast("date"))).alias(f"{n}_{self.dated}") for f, n in ((F.min, "min"), (F.max, "max"))] if self.dated else []
        return references.groupBy("profile_date").agg(*[count_if(of(c)).alias(k) for k, c in self.distinct.items()], *days)

    def figures(self, lines: DataFrame) -> DataFrame:
        """All figures of a table, a row per day; it is read once per kind of figure, two to twelve columns each."""
        rows = self.weighted(lines)
        return self.together([self.sums(rows), self.distinct_figures(self.references(rows)), *self.per_transaction(rows)])

    def together(self, parts: list[DataFrame]) -> DataFrame:
        """Rows of figures added up by day; a figure a part does not have counts as none."""
        whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        dates = {f"{n}_{self.dated}": f for f, n in ((F.min, "min"), (F.max, "max"))}
        return whole.groupBy("profile_date").agg(*[
            dates[c](c).alias(c) if c in dates else F.coalesce(F.sum(c), F.lit(0)).cast(whole.schema[c].dataType).alias(c)
            for c in whole.columns if c != "profile_date"
        ])


def _total(m: str, whole: bool = False) -> Column:
    """The sum of a measure, NULL if no line has one."""
    held = F.when(F.col(f"n_{m}") > 0, F.col(f"sum_{m}"))
    return held.cast("bigint") if whole else money_total(held, 4)


def _mean(m: str) -> Column:
    return money_total(F.col(f"sum_{m}").cast("double") / F.nullif(F.col(f"n_{m}").cast("double"), F.lit(0.0)), 4)


def _headers(lines: DataFrame, transaction: str, order: list[Column]) -> DataFrame:
    """The header money of each transaction, on the day of its first line."""
    heads = first_line_per_transaction(lines, transaction, order)
    return heads.groupBy("profile_date").agg(F.sum(F.col("total_amount").cast("decimal(28,8)")).cast("decimal(38,8)").alias("sum_headers"))


class StagingLayer(Layer):
    """AGG1: by staging day."""

    name, at, transaction, columns = "staging", "staging_processed_at", "transaction_id_clean", STAGING_COLUMNS
    measures = ["line_total", "quantity"]
    distinct = {"unique_customers": "customer_id", "unique_products_sold": "product_id", "unique_stores": "store_id"}
    line = ["transaction_id_clean", "product_id", "transaction_id_raw", "total_amount"]
    dated = "transaction_date"

    def counts(self) -> dict[str, Column]:
        flags = {
            "missing_transaction_id_clean_count": "missing_transaction_id_flag", "missing_date_count": "missing_date_flag",
            "missing_customer_id_count": "missing_customer_id_flag", "missing_product_id_count": "missing_product_id_flag",
            "negative_quantity_count": "negative_quantity_flag", "negative_amount_count": "negative_amount_flag",
            "zero_total_count": "zero_total_amount_flag", "zero_quantity_count": "zero_quantity_flag", "high_unit_price_count": "high_unit_price_flag",
        }
        return {k: F.col(c) == 1 for k, c in flags.items()} | {
            "refund_line_items": F.col("is_refund"), "promotion_line_items": F.col("has_promotion"), "negative_quantity_lines": F.col("quantity") < 0,
        }

    def per_transaction(self, lines: DataFrame) -> list[DataFrame]:
        per_pair = lines.groupBy("profile_date", "transaction_id_clean", "product_id").agg(F.sum("w").alias("n"))
        # Partitions of this window hold one row per day a line was staged on.
        pair = Window.partitionBy("transaction_id_clean", "product_id")
        pairs = per_pair.withColumn("occurrences", F.sum("n").over(pair)).groupBy("profile_date").agg(
            F.count("*").alias("unique_txn_product_combinations"), F.countDistinct("transaction_id_clean").alias("unique_transactions"),
            F.sum(F.when(F.col("occurrences") > 1, F.col("n")).otherwise(0)).alias("duplicate_txn_product_line_items"),
        )
        order = [F.col("product_id").asc_nulls_last(), F.col("transaction_id_raw").asc(), F.col("total_amount").asc(), F.col("profile_date").asc()]
        return [pairs, _headers(lines, "transaction_id_clean", order)]

    def finish(self, figures: DataFrame) -> DataFrame:
        c, total = F.col, F.col("total_line_items")
        pct = lambda n: percent(c(n), total)
        return figures.select(
            "profile_date", "min_transaction_date", "max_transaction_date", "total_line_items", "unique_transactions", *self.distinct,
            *list(self.counts())[:9], _total("line_total").alias("total_line_item_revenue"), _mean("line_total").alias("avg_line_item_value"),
            _total("quantity", True).alias("total_quantity_sold"), _mean("quantity").alias("avg_quantity_per_line"),
            *list(self.counts())[9:], "unique_txn_product_combinations", "duplicate_txn_product_line_items",
            money_total(c("sum_headers"), 4).alias("total_transaction_revenue"),
            money_total(percent(total, c("unique_transactions")) / 100.0).alias("avg_line_items_per_transaction"),
            money_total(pct("missing_transaction_id_clean_count")).alias("missing_txn_id_pct"),
            money_total(pct("missing_date_count")).alias("missing_date_pct"),
            money_total(pct("missing_customer_id_count")).alias("missing_customer_pct"),
            money_total(pct("missing_product_id_count")).alias("missing_product_pct"),
            money_total(pct("negative_quantity_count")).alias("negative_quantity_pct"),
            money_total(pct("zero_total_count")).alias("zero_total_pct"),
            money_total(clamped_score([
                pct("missing_transaction_id_clean_count"), pct("missing_date_count"), pct("missing_product_id_count"),
                pct("negative_quantity_count") * 0.5, pct("zero_total_count") * 0.5,
            ]), 4).alias("line_item_quality_score"),
        )


def staging_profile(staged: DataFrame) -> DataFrame:
    """AGG1: one row per staging day.  ``staged`` should be a stored table: it is read once per kind of figure."""
    return StagingLayer().finish(StagingLayer().figures(staged))


def grade_staging(profile: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """AGG2: health, tier, alert and ratios of the staging profile."""
    c = F.col
    dup, total = c("duplicate_txn_product_line_items"), c("total_line_items")
    worst = F.greatest("missing_txn_id_pct", "missing_date_pct", "missing_product_pct")
    tier = (
        F.when((worst == 0) & (c("negative_quantity_pct") < 1), "CLEAN")
        .when((worst < 5) & (c("negative_quantity_pct") < 5), "ACCEPTABLE").otherwise("POOR")
    )
    grain = (
        F.when((total == c("unique_txn_product_combinations")) | (dup == 0), "Clean - No Duplicates")
        .when(dup < total * 0.01, "Good - <1% Duplicates").when(dup < total * 0.05, "Fair - <5% Duplicates")
        .otherwise("Poor - 5%+ Duplicates")
    )
    return profile.select(
        "*", grain.alias("line_item_grain_health"),
        ladder(c("avg_line_items_per_transaction"), BASKETS, "High - Many Multi-Item Transactions").alias("transaction_size_health"),
        ladder(c("line_item_quality_score"), STAGING_HEALTH, "Critical").alias("health_status"),
        tier.alias("quality_tier"),
        ((c("line_item_quality_score") < 70) | (worst > 10) | (dup > total * 0.1)).alias("quality_alert_flag"),
        money_total(percent(total, c("unique_transactions")) / 100.0).alias("actual_line_items_per_txn_ratio"),
        money_total(percent(dup, total)).alias("duplicate_line_item_pct"),
        ctx.now.alias("profile_created_at"), F.lit(ctx.source_system).alias("source_system"), F.lit("line_item").alias("grain_level"),
    )


class IntermediateLayer(Layer):
    """AGG3: by processing day."""

    name, at, transaction, columns = "intermediate", "intermediate_processed_at", "transaction_id", INTERMEDIATE_COLUMNS
    measures = ["line_total_clean", "quantity_clean", "discount_percent", "discount_amount", "loyalty_points_earned"]
    distinct = {
        "unique_customers": "customer_id", "unique_products_sold": "product_id", "unique_stores": "store_id", "unique_payment_methods": "payment_method",
    }
    line = ["transaction_id", "product_id", "line_item_key", "total_amount"]

    def counts(self) -> dict[str, Column]:
        c = F.col
        status = {"clean_records": "CLEAN", "corrected_records": "CORRECTED", "incomplete_records": "INCOMPLETE"}
        flags = {
            "refund_line_items": "is_refund", "promotion_line_items": "has_promotion", "discount_line_items": "has_discount",
            "bulk_purchase_line_items": "is_bulk_purchase", "high_value_line_items": "is_high_value_item",
            "weekend_transactions": "is_weekend", "transactions_with_loyalty_points": "earned_loyalty_points",
        }
        types = {"regular_sale_items": "Regular Sale", "discounted_items": "Discounted", "refund_items": "Refund"}
        parts = {"morning_transactions": "Morning", "afternoon_transactions": "Afternoon", "evening_transactions": "Evening"}
        return (
            {k: c("data_quality_status") == v for k, v in status.items()} | {k: c(v) for k, v in flags.items()}
            | {k: c("transaction_type") == v for k, v in types.items()} | {"promotional_items": c("transaction_type").contains("Promotion")}
            | {k: c("time_of_day").contains(v) for k, v in parts.items()}
        )

    def per_transaction(self, lines: DataFrame) -> list[DataFrame]:
        # A line's key follows from its transaction and product, so no key stands in two transactions.  It travels packed.
        keys = lines.groupBy("profile_date", "transaction_id", packed_key(F.col("line_item_key")).alias("line_item_key")).agg(F.sum("w").alias("n"))
        unique = keys.groupBy("profile_date").agg(F.count("line_item_key").alias("unique_line_items"), F.countDistinct("transaction_id").alias("unique_transactions"))
        return [unique, _headers(lines, "transaction_id", [F.col("product_id").asc_nulls_last(), F.col("line_item_key").asc()])]

    def finish(self, figures: DataFrame) -> DataFrame:
        c, total = F.col, F.col("total_line_items")
        pct = lambda n: percent(c(n), total)
        return figures.select(
            "profile_date", "total_line_items", "unique_line_items", "unique_transactions", *self.distinct, *self.counts(),
            _total("line_total_clean").alias("total_line_item_revenue"), _mean("line_total_clean").alias("avg_line_item_value"),
            _total("quantity_clean", True).alias("total_quantity_sold"), _mean("quantity_clean").alias("avg_quantity_per_line"),
            _mean("discount_percent").alias("avg_discount_percent"), _total("discount_amount").alias("total_discount_amount"),
            _total("loyalty_points_earned", True).alias("total_loyalty_points_earned"),
            money_total(c("sum_headers"), 4).alias("total_transaction_revenue"),
            money_total(percent(total, c("unique_transactions")) / 100.0).alias("avg_items_per_transaction"),
            money_total(pct("clean_records")).alias("clean_pct"), money_total(pct("corrected_records")).alias("corrected_pct"),
            money_total(pct("refund_line_items")).alias("refund_pct"), money_total(pct("promotion_line_items")).alias("promotion_pct"),
            money_total(pct("weekend_transactions")).alias("weekend_pct"),
            money_total(clamped_score([
                pct("corrected_records") * 0.05, pct("incomplete_records") * 0.1, pct("refund_line_items") * 0.02,
            ]), 4).alias("transaction_intermediate_quality_score"),
        )


def intermediate_profile(lines: DataFrame) -> DataFrame:
    """AGG3: one row per processing day.  ``lines`` should be a stored table: it is read once per kind of figure."""
    return IntermediateLayer().finish(IntermediateLayer().figures(lines))


def grade_intermediate(profile: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """AGG4: dedup status, health, tiers, alert and dedup percentage."""
    c = F.col
    total, unique = c("total_line_items"), c("unique_line_items")
    dedup = F.when(total == unique, "Perfect - No Duplicates").when(total > unique, "WARNING - Duplicates Found").otherwise("Unknown")
    score = c("transaction_intermediate_quality_score")
    return profile.select(
        "*", dedup.alias("deduplication_status"),
        ladder(c("avg_items_per_transaction"), BASKETS, "High - Many Multi-Item Transactions").alias("transaction_size_health"),
        ladder(score, INTERMEDIATE_HEALTH, "Needs Review").alias("health_status"),
        ladder(c("clean_pct"), CLEAN_TIERS, "NEEDS_IMPROVEMENT").alias("quality_tier"),
        ladder(c("refund_pct"), REFUND_HEALTH, "NORMAL_REFUNDS").alias("refund_health"),
        ladder(c("promotion_pct"), PROMOTIONS, "LOW_PROMOTIONS").alias("promotion_intensity"),
        ((score < 90) | (c("clean_pct") < 90) | (c("refund_pct") > 10) | (total < 1000)).alias("quality_alert_flag"),
        money_total(percent(unique, total)).alias("deduplication_success_pct"),
        ctx.now.alias("profile_created_at"), F.lit("transaction").alias("entity_type"), F.lit("line_item").alias("grain_level"),
    )


def latest_day(profile: DataFrame) -> DataFrame:
    """The profile of the last day: gates judge the latest run, not any run."""
    return profile.orderBy(F.col("profile_date").desc()).limit(1)


def staging_gate(profile: DataFrame) -> DataFrame:
    """GAT1: one row with the verdict."""
    score = F.coalesce("line_item_quality_score", F.lit(0.0))
    return latest_day(profile).select(
        "profile_date", "total_line_items", "unique_txn_product_combinations", "avg_line_items_per_transaction",
        score.alias("line_item_quality_score"), F.coalesce("duplicate_line_item_pct", F.lit(0.0)).alias("duplicate_line_item_pct"),
        "health_status", "quality_tier", (score >= STAGING_MIN_SCORE).alias("passed"),
    )


def intermediate_gate(profile: DataFrame) -> DataFrame:
    """GAT2: one row with every condition and the verdict."""
    c, lim = F.col, INTERMEDIATE_LIMITS
    checks = {
        "dedup_perfect": c("deduplication_success_pct") == lim["dedup_pct"],
        "quality_ok": c("transaction_intermediate_quality_score") >= lim["min_score"],
        "clean_ok": c("clean_pct") >= lim["min_clean"],
        "refund_ok": c("refund_pct") <= lim["max_refund"],
        "avg_items_ok": c("avg_items_per_transaction").between(lim["min_items"], lim["max_items"]),
        "unique_ok": c("total_line_items") == c("unique_line_items"),
    }
    judged = latest_day(profile).select(
        "profile_date", "total_line_items", "unique_line_items", "unique_transactions", "avg_items_per_transaction",
        "clean_pct", "corrected_pct", "refund_pct", "deduplication_success_pct", "transaction_intermediate_quality_score",
        "health_status", "quality_tier", *[v.alias(k) for k, v in checks.items()],
    )
    return judged.withColumn("passed", F.expr(" and ".join(checks)))


def dimension_counts(dims: dict[str, DataFrame]) -> DataFrame:
    """AGG8: one row per dimension."""
    parts = [d.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("dimension"), "row_count") for name, d in dims.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fact_statistics(fact: DataFrame) -> DataFrame:
    """AGG9: one row over sales without refunds."""
    return fact.where("not is_refund").agg(
        F.count("*").alias("total_sales"),
        F.countDistinct("customer_key").alias("unique_customers"), F.countDistinct("product_key").alias("unique_products"),
        F.countDistinct("store_key").alias("unique_stores"),
        revenue_sum("line_total").alias("total_revenue"), revenue_sum("line_profit").alias("total_profit"),
        F.min("transaction_date").alias("earliest_date"), F.max("transaction_date").alias("latest_date"),
    )


def orphan_counts(looked_up: DataFrame) -> DataFrame:
    """AGG10: lines without a dimension match, from the lookup itself.

    Unknown products each have their own key, so counting one fixed key would
    always give zero for them.
    """
    return looked_up.agg(*[
        F.count_if(F.col(f"{d}_key").isNull()).alias(f"orphan_{d}s") for d in ("customer", "product", "store")
    ])


def gold_gate(counts: DataFrame, stats: DataFrame, orphans: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """GAT3: row minimums decide, orphans and staleness cost points.

    All inputs are one-row or four-row aggregates.
    """
    c, lim = F.col, GOLD_LIMITS
    wide = counts.agg(*[
        F.max(F.when(c("dimension") == f"dim_{d}", c("row_count"))).alias(f"dim_{d}_count") for d in ("customers", "products", "stores", "date")
    ])
    row = wide.crossJoin(stats).crossJoin(orphans)
    days_old = F.datediff(ctx.today, c("latest_date"))
    score = F.lit(100.0)
    for d in ("customers", "products", "stores"):
        score = score - F.when(c(f"orphan_{d}") > lim["orphans"], 10).otherwise(0)
    score = score - F.when(days_old > lim["stale_days"], 5).otherwise(0)
    enough = (
        (c("dim_customers_count") >= lim["customers"]) & (c("dim_products_count") >= lim["products"])
        & (c("dim_stores_count") >= lim["stores"]) & (c("total_sales") >= lim["sales"])
    )
    return row.select(
        "dim_customers_count", "dim_products_count", "dim_stores_count", "dim_date_count",
        "total_sales", "total_revenue", "orphan_customers", "orphan_products", "orphan_stores",
        days_old.alias("days_old"), score.alias("quality_score"),
        (c("dim_date_count") == lim["calendar"]).alias("calendar_complete"), enough.alias("passed"),
    )


def gold_metrics(counts: DataFrame, fact: DataFrame, orphans: DataFrame, gate: DataFrame, ctx: RunContext = DEFAULT) -> DataFrame:
    """AGG11: the metrics row of a run, typed like the log it is appended to."""
    c = F.col
    wide = counts.agg(*[
        F.max(F.when(c("dimension") == f"dim_{d}", c("row_count"))).cast("bigint").alias(f"dim_{d}_count")
        for d in ("customers", "products", "stores", "date")
    ])
    sales = fact.where("not is_refund").agg(
        F.count("*").alias("total_sales_records"),
        exact_sum(c("line_total")).cast("decimal(30,2)").alias("total_revenue"),
        exact_sum(c("line_profit")).cast("decimal(30,2)").alias("total_profit"),
        F.avg("line_profit_margin_pct").try_cast("decimal(18,2)").alias("profit_margin_pct"),
    )
    lost = orphans.select(*[c(o).cast("bigint").alias(o) for o in orphans.columns])
    score = gate.select(c("quality_score").cast("decimal(5,2)").alias("quality_score"))
    return wide.crossJoin(sales).crossJoin(score).crossJoin(lost).select(
        ctx.now.alias("run_date"), F.lit(ctx.batch_id).alias("run_id"), "*", ctx.now.alias("created_at")
    )
