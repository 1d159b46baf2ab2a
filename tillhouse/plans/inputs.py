"""The layered tables over the given data, as lazily built DataFrames.

``processed_at`` is the first of the month after a row was loaded: the history
then looks like monthly runs, which gives profiles and watermarks real work.
"""

from __future__ import annotations

import datetime as dt
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.context import DEFAULT, RunContext
from tillhouse.functions import buckets, flags, text
from tillhouse.operators.dedup import DEALT, DEALT_TRANSACTION, dealt_by_product, dealt_by_transaction, latest_line
from tillhouse.plans import intermediate, marts, staging
from tillhouse.session import materialise
from tillhouse.sources import standin

FIRST_RUN = RunContext(as_of=dt.date(1998, 12, 31), run_ts=dt.datetime(1998, 12, 31, 6), batch_id="batch-19981231")
DAYS_BETWEEN_RUNS = (DEFAULT.as_of - FIRST_RUN.as_of).days


def first_batch(name: str, now: DataFrame) -> DataFrame:
    """Master data as of the first run: what existed then, as it was then."""
    c = F.col
    if name == "customers":
        age = c("days_since_registration") - DAYS_BETWEEN_RUNS
        return now.where(c("registration_date") <= FIRST_RUN.today).withColumns(
            {"days_since_registration": age, "customer_tenure_category": buckets.tenure_by_days(age)}
        )
    if name == "products":
        young = c("days_since_launch") - DAYS_BETWEEN_RUNS < 180
        return now.where(c("launch_date") <= FIRST_RUN.today).withColumn(
            "supplier", F.when(young, "Launch vendor").otherwise(c("supplier"))
        )
    young = c("days_since_opening") - DAYS_BETWEEN_RUNS < 1825
    return now.where(c("opening_date") <= FIRST_RUN.today).withColumn(
        "manager", F.when(young, "Acting manager").otherwise(c("manager"))
    )


def monthly_run(loaded_at: str) -> Column:
    """When the monthly run after ``loaded_at`` took place."""
    return F.add_months(F.trunc(loaded_at, "MM"), 1).cast("timestamp_ntz")


def built_once(method):
    """A table's plan is put together once per warehouse, however many tables use it."""
    @wraps(method)
    def build(self, *args):
        key = (method.__name__, *args)
        if key not in self.plans:
            self.plans[key] = method(self, *args)
        return self.plans[key]

    return build


class Warehouse:
    """Each method builds one table from the ones below it; nothing runs until asked.

    ``whole`` is for plans that keep all columns of the till lines.  The clean store names are then stored first:
    Spark sees that they are few and broadcasts them, where an aggregation of unknown size would have all lines
    shuffled by store.  Plans that do not use the names drop their join, and need not wait for them.

    Lines are dealt out by product, which is looked up, or ``by_transaction`` for plans that look no product up and
    count transactions: their lines then lie together and are added up before they travel.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, ctx: RunContext = DEFAULT, whole: bool = False, by_transaction: bool = False):
        self.spark, self.sf_dir, self.ctx, self.whole, self.by_transaction = spark, sf_dir, ctx, whole, by_transaction
        self.dealt = DEALT_TRANSACTION if by_transaction else DEALT
        self.plans: dict[tuple, DataFrame] = {}

    @built_once
    def raw(self, name: str) -> DataFrame:
        return getattr(standin, f"raw_{name}")(self.spark, self.sf_dir)

    @built_once
    def zips(self) -> DataFrame:
        return standin.zip_lookup(self.spark, self.sf_dir)

    @built_once
    def stg_customers(self) -> DataFrame:
        return staging.stage_customers(self.raw("customers"), self.zips(), self.ctx)

    @built_once
    def stg_products(self) -> DataFrame:
        raw = self.raw("products")
        return staging.stage_products(raw, staging.canonical_names(raw, "product_id", "product_name"), self.ctx)

    @built_once
    def stg_stores(self) -> DataFrame:
        raw = self.raw("stores")
        return staging.stage_stores(raw, staging.canonical_names(raw, "store_id", "store_name"), self.ctx)

    @built_once
    def store_names(self) -> DataFrame:
        names = staging.store_name_of_lines(self.raw("transactions"))
        return materialise(names, "store-names") if self.whole else names

    def _staged(self, raw: DataFrame, also: list[str] | None = None, names: DataFrame | None = None) -> DataFrame:
        names = self.store_names() if names is None else names
        return staging.stage_transactions(raw, names, self.ctx, monthly_run("data_created_modified"), also)

    def _apart(self, df: DataFrame, name: str) -> DataFrame:
        """The same rows; of ``whole`` lines, what comes before is compiled apart from what comes after.

        The count between is not compiled.  Lines derived, staged and classified by one generated method exceed what
        the JVM compiles (8,000 bytes of code) and take nearly twice the time.
        """
        return df if not self.whole else df.observe(f"{name}-{id(self)}", F.count("*").alias("n"))

    @built_once
    def stg_transactions(self) -> DataFrame:
        raw = self.raw("transactions")
        return self._staged(self._apart(raw, "raw"))

    @built_once
    def kept_lines(self) -> DataFrame:
        """Staged lines that the intermediate layer keeps, beside what they were derived from.

        Lines are dealt out once, as they were read, and derived where they arrive: staged lines are five times as wide.
        """
        lines, ids = standin.till_lines(self.spark, self.sf_dir), standin.line_ids()
        deal = dealt_by_transaction if self.by_transaction else dealt_by_product
        dealt = deal(lines, text.strip_dup_marker(ids["transaction_id"]), ids["product_id"])
        # Not the stored names: one per store for sure, their join is dropped where no name is read.
        names = staging.store_name_of_lines(self.raw("transactions"))
        staged = self._staged(self._apart(standin.raw_of_lines(dealt, dealt.columns), "dealt"), dealt.columns, names)
        return intermediate.admit_transactions(latest_line(staged, self.dealt))

    def refined_lines(self) -> DataFrame:
        """Intermediate lines for plans that read some columns of them, from lines dealt out as they were read."""
        return intermediate.classify_transactions(self.kept_lines(), self.ctx, F.col("staging_processed_at"), self.dealt)

    @built_once
    def intmd_customers(self) -> DataFrame:
        return intermediate.refine_customers(self.stg_customers(), self.zips(), self.ctx)

    @built_once
    def intmd_products(self) -> DataFrame:
        return intermediate.refine_products(self.stg_products(), self.ctx)

    @built_once
    def intmd_stores(self) -> DataFrame:
        return intermediate.refine_stores(self.stg_stores(), self.ctx)

    @built_once
    def intmd_transactions(self) -> DataFrame:
        if not self.whole:
            return intermediate.refine_transactions(self.stg_transactions(), self.ctx, F.col("staging_processed_at"))
        return self._classified(self.kept_lines())

    def _classified(self, kept: DataFrame, also: list[str] | None = None) -> DataFrame:
        """Whole intermediate lines, derived once more from what they were derived from."""
        staged = self._staged(self._apart(standin.raw_of_lines(kept, also), "raw"), also)
        return intermediate.classify_transactions(self._apart(staged, "staged"), self.ctx, F.col("staging_processed_at"), also)

    @built_once
    def dim(self, name: str) -> DataFrame:
        return marts.load_dimension(name, getattr(self, f"intmd_{name}")(), self.ctx)

    def dim_date(self) -> DataFrame:
        return marts.dim_date(marts.date_spine(self.spark, marts.CALENDAR_START, marts.CALENDAR_END), self.ctx)

    @built_once
    def sales(self) -> DataFrame:
        """The fact's own columns, for reports that need no dimension: nothing is looked up."""
        c = F.col
        return self.intmd_transactions().select(
            "transaction_id", "product_id", "customer_id", "store_id", "store_name", "transaction_date", "transaction_year",
            "transaction_month", "category", "payment_method", "payment_status", "is_refund",
            c("line_total_clean").alias("line_total"), c("quantity_clean").alias("quantity"),
        )

    @built_once
    def looked_up(self) -> DataFrame:
        """Intermediate lines with their dimension keys.

        Of ``whole`` lines what they are derived from travels through the lookups, of others the columns that are read.
        The line's key, a hash that does not compress, is made from its parts afterwards.
        """
        dims = [self.dim(name) for name in ("customers", "products", "stores")]
        if self.whole:
            return self._classified(marts.star_lookup(self.kept_lines(), *dims), marts.LOOKED_UP)
        key = flags.surrogate_key(F.col("transaction_id"), F.col("product_id"))
        return marts.star_lookup(self.refined_lines(), *dims).withColumn("line_item_key", key)

    @built_once
    def fact(self) -> DataFrame:
        return marts.sold_lines(self.looked_up(), self.ctx)

    def dim_batches(self, name: str) -> tuple[DataFrame, DataFrame]:
        """Two dated batches of a dimension: what was known at the end of 1998, and now."""
        now = getattr(self, f"intmd_{name}")()
        return first_batch(name, now), now

    def merged_dim(self, name: str) -> DataFrame:
        """The dimension after both batches."""
        first, second = self.dim_batches(name)
        loaded = marts.load_dimension(name, first, FIRST_RUN)
        return marts.merge_dimension(name, loaded, second, self.ctx)

    def table(self, name: str) -> DataFrame:
        """Any table of the warehouse by its name; dimensions as their current rows."""
        layer, _, rest = name.partition("_")
        if layer == "raw":
            return self.raw(rest)
        if name in ("dim_date",) or layer in ("stg", "intmd"):
            return getattr(self, name)()
        if layer == "dim":
            return self.dim(rest)
        build = {
            "fact_sales": self.fact,
            "revenue_performance": lambda: marts.revenue_performance(self.fact(), self.ctx),
            "store_performance": lambda: marts.store_performance(self.fact(), self.dim("stores"), self.ctx),
            "products_performance": lambda: marts.products_performance(self.fact(), self.dim("products"), self.ctx),
            "customer_metrics": lambda: marts.customer_metrics(self.fact(), self.dim("customers"), self.ctx),
        }
        return build[name]()
