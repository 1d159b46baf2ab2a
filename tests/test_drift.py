"""Schema drift is resolved by its kind."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F
from tables import SF_DIR

from tillhouse.context import DEFAULT as CTX
from tillhouse.context import RunContext
from tillhouse.operators import drift
from tillhouse.sources import schemas, sinks

c = F.col


@pytest.mark.parametrize("held, fresh, kinds, method", [
    ("a int, b string", "b string, a int", {}, None),
    ("a int", "a int, z date", {"added": ("z",)}, "schema_version"),
    ("a int, d date, f float", "a bigint, d timestamp_ntz, f double", {"widened": ("a", "d", "f")}, "schema_version"),
    ("a decimal(10,2)", "a decimal(12,2)", {"widened": ("a",)}, "schema_version"),
    ("a decimal(10,2)", "a decimal(11,4)", {"incompatible": ("a",)}, "full_refresh"),
    ("a bigint", "a int", {"narrower": ("a",)}, None),
    ("a bigint", "a double", {"incompatible": ("a",)}, "full_refresh"),
    ("a string, b int", "a int, b bigint, y int", {"incompatible": ("a",), "widened": ("b",), "added": ("y",)}, "full_refresh"),
    ("a int, b int", "a int", {"removed": ("b",)}, "full_refresh"),
])
def test_kinds(spark, held, fresh, kinds, method):
    found = drift.classify(schemas.struct(held), schemas.struct(fresh))
    assert found == drift.Drift(**kinds) and found.method == method and bool(found) == bool(kinds)


def test_raw_rows_are_guarded(spark):
    want = schemas.struct("a bigint, b string")
    rows = drift.guard(spark.sql("select 1 a, 'x' b, 2 more"), want, "raw")
    assert rows.schema["a"].dataType.simpleString() == "bigint" and rows.columns == ["a", "b", "more"]
    for bad in ("select 1L a", "select 'x' a, 'x' b", "select 1.5D a, 'x' b"):
        with pytest.raises(ValueError, match="raw: schema out of sync"):
            drift.guard(spark.sql(bad), want, "raw")


def test_readers_apply_a_schema_version(spark):
    """Files of the old and of the new schema in one upserted table; a rebuilt table drops its schema version."""
    area = tempfile.mkdtemp(prefix="tillhouse-")
    path = f"{area}/t"

    def take(rows):
        return drift.reconcile(spark, path, "t", rows.schema, lambda: None, f"{area}/log", CTX.now, "b", "part")

    old = spark.createDataFrame([(1, 10, "p"), (2, 20, "p"), (3, 30, "q")], "k int, n int, part string")
    sinks.incremental_upsert(spark, path, old, ["k"], "part")
    new = spark.createDataFrame([(2, 2**40, "two", "p"), (4, 40, "four", "r")], "k int, n bigint, name string, part string")
    assert take(new.drop("part")) == "schema_version" and take(new.drop("part")) is None
    assert sinks.read_table(spark, path).schema["name"].dataType.simpleString() == "string"
    sinks.incremental_upsert(spark, path, new, ["k"], "part")
    rows = {r["k"]: (r["n"], r["name"], r["part"]) for r in sinks.read_table(spark, path).collect()}
    assert rows == {1: (10, None, "p"), 2: (2**40, "two", "p"), 3: (30, None, "q"), 4: (40, "four", "r")}
    assert take(old.drop("part", "n").withColumn("n", F.lit("x"))) == "full_refresh"
    log = spark.read.parquet(f"{area}/log").orderBy("log_id").collect()
    assert [(r["log_id"], r["reconciliation_method"]) for r in log] == [(1, "schema_version"), (2, "full_refresh")]

    whole = f"{area}/whole"
    sinks.overwrite_table(old, whole)
    drift.reconcile(spark, whole, "whole", old.withColumn("z", F.lit(1)).schema, lambda: None, f"{area}/log", CTX.now, "b")
    assert sinks.read_table(spark, whole).columns == ["k", "n", "part", "z"]
    sinks.overwrite_table(old.select("k"), whole)
    assert sinks.read_table(spark, whole).columns == ["k"] and sinks.read_table(spark, whole).count() == 3


def test_staging_is_brought_in_line(spark, monkeypatch):
    """A run whose staging has a further column, a wider one, then a column less."""
    from tillhouse.plans import daily_run, staging
    from tillhouse.sources import standin

    lake = daily_run.Lake(spark, tempfile.mkdtemp(prefix="tillhouse-"), "YEAR")
    lines = standin.raw_transactions(spark, SF_DIR)
    early = lines.where(c("data_created_modified") < F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))
    build = staging.stage_transactions

    def run(rows, change, batch_id):
        monkeypatch.setattr(staging, "stage_transactions", lambda *a: change(build(*a)))
        batch = daily_run.Batch(standin.raw_customers(spark, SF_DIR), standin.raw_products(spark, SF_DIR), standin.raw_stores(spark, SF_DIR), rows, standin.zip_lookup(spark, SF_DIR))
        daily_run.stage(lake, batch, RunContext(run_ts=dt.datetime(2001, 12, 31, 6), batch_id=batch_id))
        return lake.read("stg_transactions")

    before = run(early, lambda df: df.withColumn("short", F.lit(1)), "b1").count()
    held = run(lines, lambda df: df.withColumns({"short": F.lit(2**40), "further": F.lit("new")}), "b2")
    assert held.count() > before and held.schema["short"].dataType.simpleString() == "bigint"
    kept = held.where("further is null").count()  # rows of the first run that the second did not load again
    assert 0 < kept <= before and held.where("further is null and short = 1").count() == kept
    keys = {tuple(r) for r in held.select(*daily_run.LINE_KEY).collect()}
    last = run(lines, lambda df: df, "b3")
    # A build in one batch holds both rows of a line that was loaded twice, an upsert the later one only.
    assert "short" not in last.columns and {tuple(r) for r in last.select(*daily_run.LINE_KEY).collect()} == keys
    log = lake.read("schema_change_log").orderBy("log_id").collect()
    assert [(r["model_name"], r["reconciliation_method"], r["run_id"]) for r in log] == [
        ("stg_transactions", "schema_version", "b2"), ("stg_transactions", "full_refresh", "b3"),
    ]
    with pytest.raises(ValueError, match="out of sync"):
        run(lines.drop("quantity"), lambda df: df, "b4")
