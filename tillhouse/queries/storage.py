"""SRC*, SNK*, DRF1: reading and writing tables, with the result read back."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.context import DEFAULT as CTX
from tillhouse.operators import drift, incremental
from tillhouse.operators.streams import flatten_items
from tillhouse.plans.inputs import Warehouse
from tillhouse.queries.registry import query
from tillhouse.session import shared_folder
from tillhouse.sources import files, schemas, sinks, standin
from tillhouse.sources.files import table
from tillhouse.sources.manifests import Snapshot

c = F.col
CUT = dt.datetime(1999, 1, 1)


def _area(spark) -> str:
    return f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"


@query("src1_scan_parquet")
def src1(spark, sf):
    return files.scan_parquet(spark, f"{sf}/customer.parquet", schemas.TABLES["customer"])


@query("src2_scan_daily_files")
def src2(spark, sf):
    """Raw lines landed in one folder per month, then read by a pattern.

    Every task lands its own lines: each goes to its folder once, and no wide line is shuffled for it.
    """
    area = _area(spark)
    raw = standin.raw_transactions(spark, sf).withColumnRenamed("data_created_modified", "data_created/modified")
    month = F.date_format(F.col("`data_created/modified`"), "yyyy-MM")
    raw.withColumn("month", month).write.partitionBy("month").parquet(f"{area}/landing")
    back = files.scan_parquet_glob(spark, f"{area}/landing/month=*", schemas.RAW_TRANSACTIONS)
    return back.select("transaction_id", "product_id", "quantity", "data_created_modified")


@query("src3_file_listing")
def src3(spark, sf):
    return files.file_listing(spark, f"{sf}/*.parquet")


@query("src4_attach_file_metadata")
def src4(spark, sf):
    df = files.attach_file_metadata(table(spark, sf, "customer"))
    return df.select("c_custkey", "c_name", "filename")


@query("src5_attach_metadata_by_key")
def src5(spark, sf):
    """Days with an order stand in for days with a file."""
    day = c("o_orderdate").cast("date")
    listing = table(spark, sf, "orders").groupBy(F.date_format(day, "yyyyMMdd").alias("date_key")).agg(
        F.count("*").alias("size"), F.date_add(F.max(day), 1).alias("modified_date")
    )
    out = files.attach_metadata_by_key(standin.raw_transactions(spark, sf), listing)
    return out.select("transaction_id", "product_id", "_loaded_at_date")


@query("src6_scan_seed_csv")
def src6(spark, sf):
    area = _area(spark)
    standin.zip_lookup(spark, sf).write.option("header", True).csv(f"{area}/zips")
    return files.scan_seed_csv(spark, f"{area}/zips")


@query("src8_flatten_items")
def src8(spark, sf):
    return flatten_items(standin.nested_transactions(spark, sf)).drop("store_id", "datetime")


@query("snk1_incremental_upsert")
def snk1(spark, sf):
    """Two loads into a table kept by month; some lines of the first are replaced."""
    area = _area(spark)
    lines = Warehouse(spark, sf).stg_transactions().select(
        "transaction_id_clean", "product_id", "transaction_id_raw", "staging_processed_at", "quantity", F.trunc("transaction_date", "MM").alias("month")
    )
    before = c("staging_processed_at") < F.lit(str(CUT)).cast("timestamp_ntz")
    keys = ["transaction_id_clean", "product_id"]
    lines.withColumn("first_load", before).write.partitionBy("first_load").parquet(f"{area}/loads")
    loads = spark.read.schema(lines.schema.add("first_load", "boolean")).parquet(f"{area}/loads")
    for batch in (loads.where("first_load"), loads.where("not first_load")):
        sinks.incremental_upsert(spark, f"{area}/lines", batch.drop("first_load"), keys, "month", stored=True)
    return spark.read.parquet(f"{area}/lines")


@query("snk2_overwrite_table")
def snk2(spark, sf):
    area = _area(spark)
    sinks.overwrite_table(table(spark, sf, "part").where("p_size > 25"), f"{area}/part")
    sinks.overwrite_table(table(spark, sf, "part"), f"{area}/part")
    return sinks.read_table(spark, f"{area}/part")


@query("snk4_write_if_absent")
def snk4(spark, sf):
    area = _area(spark)
    for size in ("p_size <= 25", "p_size > 25"):
        sinks.write_if_absent(table(spark, sf, "part").where(size), f"{area}/part")
    return spark.read.parquet(f"{area}/part").select("p_partkey", "p_size")


@query("snk6_publish_snapshot")
def snk6(spark, sf):
    area = _area(spark)
    names = ("customer", "part", "supplier")
    for n in names:
        sinks.overwrite_table(table(spark, sf, n), f"{area}/{n}")
    snapshot = Snapshot(spark, f"{area}/bi")
    for _ in range(2):  # the second time nothing is copied
        record = snapshot.publish({n: f"{area}/{n}" for n in names}, CTX.now)
    rows = snapshot.read(names[0]).select(F.lit(names[0]).alias("name"))
    for n in names[1:]:
        rows = rows.unionByName(snapshot.read(n).select(F.lit(n).alias("name")))
    return rows.groupBy("name").agg(F.count("*").alias("rows")).crossJoin(F.broadcast(record))


@query("snk7_append_log")
def snk7(spark, sf):
    area = _area(spark)
    for name in ("customer", "part", "orders"):
        row = table(spark, sf, name).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        sinks.append_log(spark, f"{area}/log", row, "log_id")
    return spark.read.parquet(f"{area}/log")


@query("drf1_rebuild_on_drift")
def drf1(spark, sf):
    """A narrower stored table is rebuilt and the rebuild logged; a second run finds nothing to do."""
    area = _area(spark)
    fresh = table(spark, sf, "customer")
    fresh.drop("c_mktsegment").write.parquet(f"{area}/customer")
    runs = [
        incremental.rebuild_on_drift(spark, f"{area}/customer", "stg_customers", fresh, f"{area}/log", CTX.now, CTX.batch_id) for _ in range(2)
    ]
    log = spark.read.parquet(f"{area}/log")
    counted = sinks.read_table(spark, f"{area}/customer").agg(F.count("c_mktsegment").alias("rows"))
    return log.crossJoin(counted).select("*", F.lit(runs[0]).alias("first_run"), F.lit(runs[1]).alias("second_run"))


@query("drf1_drift_by_kind")
def drf1_kinds(spark, sf):
    """Customers stored without a column, with a narrower key, with text for a number and with a column more; then in line."""
    area, fresh = _area(spark), table(spark, sf, "customer")
    stored = {
        "added": fresh.drop("c_mktsegment"), "widened": fresh.withColumn("c_custkey", c("c_custkey").cast("int")),
        "incompatible": fresh.withColumn("c_acctbal", c("c_acctbal").cast("string")), "removed": fresh.withColumn("c_phone", F.lit("1")), "same": fresh,
    }
    parts = []
    for kind, held in stored.items():
        path = f"{area}/{kind}"
        held.write.parquet(path)
        for _ in range(2):  # the second time there is nothing to do
            drift.reconcile(spark, path, kind, fresh.schema, lambda p=path: sinks.overwrite_table(fresh, p), f"{area}/log", CTX.now, CTX.batch_id)
        now = sinks.read_table(spark, path).select(*fresh.columns)
        sums = now.agg(F.count("*").alias("rows"), F.sum("c_custkey").alias("keys"), F.count("c_mktsegment").alias("segments"), F.count("c_acctbal").alias("balances"))
        parts.append(sums.select(F.lit(kind).alias("model_name"), "*"))
    log = spark.read.parquet(f"{area}/log").select("model_name", "log_id", "reconciliation_method")
    return reduce(DataFrame.unionByName, parts).join(log, "model_name", "left")
