"""One batch through all layers, on stored tables, with a gate after each layer.

Every table lives in a folder of the lake.  Master data is captured by row hash
and transactions by load time; a table is brought forward by upsert, a dimension
by a commit of the parts in which it changed.  Line tables whose schema has
drifted are brought in line first, by a schema version or by building them anew.  A run repeated with the same input changes nothing, so a run
that was cut short is simply started again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.context import RunContext
from tillhouse.operators import drift, incremental, scd
from tillhouse.plans import intermediate, marts, profiles, staging
from tillhouse.plans.profile_state import ProfileState
from tillhouse.session import materialise
from tillhouse.sources import schemas, sinks
from tillhouse.sources.dimensions import Dimension
from tillhouse.sources.manifests import PartTable, Snapshot

MASTER = ("customers", "products", "stores")
TABLE_OF = {"staging": "stg_transactions", "intermediate": "intmd_transactions"}
# A copy of a line has a raw id of its own: loading a line again replaces that line only.
LINE_KEY = ["transaction_id_clean", "product_id", "transaction_id_raw"]


@dataclass
class Batch:
    """What one run reads."""

    customers: DataFrame
    products: DataFrame
    stores: DataFrame
    transactions: DataFrame
    zips: DataFrame


class Lake:
    """Folders of stored tables; line tables are partitioned by ``grain`` of their date."""

    def __init__(self, spark: SparkSession, root: str, grain: str = "DAY"):
        self.spark, self.root, self.grain = spark, root, grain

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def has(self, name: str) -> bool:
        return sinks.table_exists(self.spark, self.path(name))

    def read(self, name: str) -> DataFrame:
        parts = PartTable(self.spark, self.path(name))
        return parts.read() if parts.exists() else sinks.read_table(self.spark, self.path(name))

    def dimension(self, name: str) -> Dimension:
        return Dimension(self.spark, self.path(f"dim_{name}"), *marts.DIMENSIONS[name])

    def published(self) -> Snapshot:
        """The reporting copy."""
        return Snapshot(self.spark, self.path("bi"))

    def replace(self, name: str, df: DataFrame) -> None:
        sinks.overwrite_table(df, self.path(name))

    def upsert_lines(self, name: str, batch: DataFrame, keys: list[str], date: str, layer: profiles.Layer | None = None) -> None:
        """Lines: only the partitions the batch touches are rewritten, and the profile of ``layer`` takes what changed."""
        rows = batch.withColumn("part", F.date_trunc(self.grain, date).cast("date"))
        if layer is None:
            sinks.incremental_upsert(self.spark, self.path(name), rows, keys, "part")
            return
        state = self.profile_state(layer)
        state.begin()
        sinks.incremental_upsert(self.spark, self.path(name), rows, keys, "part", [layer.transaction], state.apply)

    def profile_state(self, layer: profiles.Layer) -> ProfileState:
        """What is kept of a layer's line table to profile it."""
        return ProfileState(self.spark, self.path(f"{layer.name}_profile_state"), layer, self.path(TABLE_OF[layer.name]))

    def drop(self, name: str, layer: profiles.Layer) -> None:
        """Forget a line table and what is kept of it, so that the next upsert builds it anew."""
        for path in (self.path(name), self.path(f"{layer.name}_profile_state")):
            sinks.delete(self.spark, path)

    def in_line(self, name: str, rows: DataFrame, ctx: RunContext, layer: profiles.Layer) -> bool:
        """DRF1: the stored line table takes rows of this schema; False if it had to be dropped for it."""
        if not self.has(name):
            return True
        log = self.path("schema_change_log")
        method = drift.reconcile(
            self.spark, self.path(name), name, rows.schema, lambda: self.drop(name, layer), log, ctx.now, ctx.batch_id, "part"
        )
        return method != "full_refresh"

    def like_stored(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows with the stored types where those are wider."""
        return drift.conformed(rows, self.read(name).schema) if self.has(name) else rows

    def upsert(self, name: str, batch: DataFrame, keys: list[str]) -> None:
        """Master data: small against the lines, kept as one unpartitioned table."""
        self.replace(name, sinks.upserted(self.read(name), batch, keys) if self.has(name) else batch)


def _ids(name: str) -> str:
    return marts.DIMENSIONS[name][0]


def stage(lake: Lake, batch: Batch, ctx: RunContext) -> None:
    """Staging: only rows whose content is new."""
    builders = {
        "customers": lambda: staging.stage_customers(batch.customers, batch.zips, ctx),
        "products": lambda: staging.stage_products(
            batch.products, staging.canonical_names(batch.products, "product_id", "product_name"), ctx
        ),
        "stores": lambda: staging.stage_stores(batch.stores, staging.canonical_names(batch.stores, "store_id", "store_name"), ctx),
    }
    for name, build in builders.items():
        rows, table, captured, key = build(), f"stg_{name}", f"captured_{name}", _ids(name)
        prints = incremental.source_prints(getattr(batch, name), key)
        if lake.has(table) and lake.has(captured):
            changed = materialise(incremental.hash_changes(prints, lake.read(captured), key, "_content").select(key).distinct(), f"changed-{name}")
            rows, prints = rows.join(changed, key, "left_semi"), prints.join(changed, key, "left_semi")
        lake.upsert(table, scd.one_per_id(rows, key), [key])
        lake.upsert(captured, prints, [key])  # last, so that a run cut short captures the same rows again

    table, layer = "stg_transactions", profiles.StagingLayer()
    lines = drift.guard(batch.transactions, schemas.struct(schemas.RAW_TRANSACTIONS), "raw_transactions")
    names = staging.store_name_of_lines(lines)
    if lake.in_line(table, staging.stage_transactions(lines, names, ctx), ctx, layer) and lake.has(table):
        mark = incremental.high_water_mark(lake.read(table), "raw_loaded_at")
        lines = incremental.newer_than(lines, "data_created_modified", mark, again=True)
    staged = lake.like_stored(table, staging.stage_transactions(lines, names, ctx))
    lake.upsert_lines(table, staged, LINE_KEY, "raw_loaded_at", layer)


def refine(lake: Lake, batch: Batch, ctx: RunContext) -> None:
    """Intermediate: admitted and de-duplicated rows of the staged tables."""
    lake.replace("intmd_customers", intermediate.refine_customers(lake.read("stg_customers"), batch.zips, ctx))
    lake.replace("intmd_products", intermediate.refine_products(lake.read("stg_products"), ctx))
    lake.replace("intmd_stores", intermediate.refine_stores(lake.read("stg_stores"), ctx))
    table, staged, layer = "intmd_transactions", lake.read("stg_transactions"), profiles.IntermediateLayer()
    if lake.in_line(table, intermediate.refine_transactions(staged, ctx), ctx, layer) and lake.has(table):
        # The latest copy of a line counts, so lines staged since are enough.
        mark = incremental.high_water_mark(lake.read(table), "staging_processed_at")
        staged = incremental.newer_than(staged, "staging_processed_at", mark, again=True)
    lines = lake.like_stored(table, intermediate.refine_transactions(staged, ctx))
    lake.upsert_lines(table, lines, ["line_item_key"], "transaction_date", layer)


def model(lake: Lake, ctx: RunContext) -> None:
    """Dimensions, then the fact of lines not yet in it."""
    for name in MASTER:
        lake.dimension(name).take(lake.read(f"intmd_{name}"), ctx.now)
    lake.replace("dim_date", marts.dim_date(marts.date_spine(lake.spark, marts.CALENDAR_START, marts.CALENDAR_END), ctx))
    lines = lake.read("intmd_transactions")
    if lake.has("fact_sales"):
        mark = incremental.high_water_mark(lake.read("fact_sales"), "fact_loaded_at")
        lines = incremental.newer_than(lines, "intermediate_processed_at", mark, again=True)
    fact = marts.fact_sales(lines, *[lake.dimension(n).current() for n in MASTER], ctx)
    lake.upsert_lines("fact_sales", fact, ["sales_key"], "transaction_date")


def profile(lake: Lake, ctx: RunContext, layer: str) -> DataFrame:
    """The layer's profile, upserted by day, and its gate; the table itself is not read."""
    kind, grade, gate = {
        "staging": (profiles.StagingLayer(), profiles.grade_staging, profiles.staging_gate),
        "intermediate": (profiles.IntermediateLayer(), profiles.grade_intermediate, profiles.intermediate_gate),
    }[layer]
    table = f"{layer}_transactions_profile"
    lake.upsert(table, grade(lake.profile_state(kind).profile(), ctx), ["profile_date"])
    return gate(lake.read(table))


def judge(lake: Lake, ctx: RunContext) -> tuple[DataFrame, DataFrame]:
    """The gold gate and the metrics row."""
    dims = {f"dim_{n}": lake.read(f"dim_{n}") for n in (*MASTER, "date")}
    counts = materialise(profiles.dimension_counts(dims), "dimension-counts")
    fact = lake.read("fact_sales")
    lines = lake.read("intmd_transactions").select("line_item_key", "customer_id", "product_id", "store_id")
    lost = materialise(profiles.orphan_counts(marts.star_lookup(lines, *[lake.dimension(n).current() for n in MASTER])), "orphans")
    gate = materialise(profiles.gold_gate(counts, profiles.fact_statistics(fact), lost, ctx), "gold-gate")
    return gate, profiles.gold_metrics(counts, fact, lost, gate, ctx)


def publish_marts(lake: Lake, ctx: RunContext) -> None:
    """The business marts and the reporting copy."""
    fact = lake.read("fact_sales")
    lake.replace("revenue_performance", marts.revenue_performance(fact, ctx))
    lake.replace("store_performance", marts.store_performance(fact, lake.read("dim_stores"), ctx))
    lake.replace("products_performance", marts.products_performance(fact, lake.read("dim_products"), ctx))
    lake.replace("customer_metrics", marts.customer_metrics(fact, lake.read("dim_customers"), ctx))
    names = [*[f"dim_{n}" for n in MASTER], "dim_date", "fact_sales", "gold_metrics_log"]
    lake.published().publish({n: lake.path(n) for n in names}, ctx.now)


def run(
    spark: SparkSession, root: str, batch: Batch, ctx: RunContext, enforce_gates: bool = True, grain: str = "DAY"
) -> dict[str, bool]:
    """All layers; stops after the first gate that does not pass when gates are enforced.

    A gate is one row: the only thing the driver reads between layers.
    """
    lake, verdicts = Lake(spark, root, grain), {}
    stage(lake, batch, ctx)
    verdicts["staging"] = profile(lake, ctx, "staging").first()["passed"]
    if enforce_gates and not verdicts["staging"]:
        return verdicts
    refine(lake, batch, ctx)
    verdicts["intermediate"] = profile(lake, ctx, "intermediate").first()["passed"]
    if enforce_gates and not verdicts["intermediate"]:
        return verdicts
    model(lake, ctx)
    gate, metrics = judge(lake, ctx)
    verdicts["gold"] = gate.first()["passed"]
    if enforce_gates and not verdicts["gold"]:
        return verdicts
    log = "gold_metrics_log"
    if not lake.has(log) or lake.read(log).where(F.col("run_id") == ctx.batch_id).isEmpty():
        sinks.append_log(spark, lake.path(log), metrics, "metric_id")  # a run repeated is logged once
    publish_marts(lake, ctx)
    return verdicts
