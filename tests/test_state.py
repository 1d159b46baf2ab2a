"""Dimensions, upserts and whole runs over two batches."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from tables import SF_DIR

from tillhouse.context import RunContext
from tillhouse.operators import incremental, scd
from tillhouse.session import materialise
from tillhouse.sources import schemas, sinks

c = F.col
ATTRS, TRACKED = ["name", "city"], ["city"]


def at(month):
    return F.lit(f"2024-{month:02d}-01 00:00:00").cast("timestamp_ntz")


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, city string")


def versions(df):
    return sorted(((r["id"], r["name"], r["city"], r["is_current"]) for r in df.collect()), key=str)


def test_scd2_versions(spark):
    dim = scd.initial_load(frame(spark, [("a", "A", "X"), ("b", "B", "X"), ("c", "C", None), ("d", "D", "X")]), "id", "key", ATTRS, at(1))
    batch = frame(spark, [("a", "A", "Y"), ("b", "B2", "X"), ("c", "C", "Z"), ("e", "E", "X"), ("e", "E", "X")])
    merged = scd.merge(dim, batch, "id", "key", ATTRS, TRACKED, at(2))
    assert versions(merged) == sorted([
        ("a", "A", "X", False), ("a", "A", "Y", True), ("b", "B", "X", True), ("c", "C", None, False), ("c", "C", "Z", True),
        ("d", "D", "X", True), ("e", "E", "X", True),
    ], key=str)
    closed = {r["id"]: r for r in merged.where("not is_current").collect()}
    opened = {r["id"]: r for r in merged.where("is_current").collect()}
    assert all(closed[i]["valid_end_date"] == opened[i]["valid_start_date"] for i in closed)
    assert merged.select("key").distinct().count() == merged.count()


def test_scd2_is_repeatable(spark):
    dim = scd.initial_load(frame(spark, [("a", "A", "X")]), "id", "key", ATTRS, at(1))
    batch = frame(spark, [("a", "A", "Y"), ("b", "B", "X")])
    once = scd.merge(dim, batch, "id", "key", ATTRS, TRACKED, at(2))
    again = scd.merge(once, batch, "id", "key", ATTRS, TRACKED, at(2))
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))


def test_steps_agree_with_merge(spark):
    dim = scd.initial_load(frame(spark, [("a", "A", "X"), ("b", "B", "X")]), "id", "key", ATTRS, at(1))
    batch = frame(spark, [("a", "A", "Y"), ("b", "B", "X"), ("n", "N", "X")])
    changes = scd.new_or_changed(dim, batch, "id", TRACKED)
    assert sorted(r["id"] for r in changes.collect()) == ["a", "n"]
    assert [r["id"] for r in scd.closed_versions(dim, changes, "id", at(2)).collect()] == ["a"]


def test_upsert_moves_rows_between_partitions(spark):
    path = tempfile.mkdtemp(prefix="tillhouse-") + "/t"
    ddl = "k string, v int, day date"
    d1, d2, d3 = (dt.date(2024, 1, i) for i in (1, 2, 3))
    sinks.incremental_upsert(spark, path, spark.createDataFrame([("a", 1, d1), ("b", 1, d2), ("c", 1, None)], ddl), ["k"], "day")
    second = spark.createDataFrame([("a", 2, d3), ("b", 2, d2), ("c", 2, d2), ("d", 2, d2)], ddl)
    for _ in range(2):  # a repeated batch changes nothing
        sinks.incremental_upsert(spark, path, second, ["k"], "day")
        got = sorted((r["k"], r["v"], r["day"]) for r in spark.read.parquet(path).collect())
        assert got == [("a", 2, d3), ("b", 2, d2), ("c", 2, d2), ("d", 2, d2)]


def test_upsert_keeps_duplicates_inside_a_batch(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("a", 2), ("a", 3), (None, 4)], "k string, v int")
    assert sorted(r["v"] for r in sinks.upserted(target, batch, ["k"]).collect()) == [2, 3, 4]
    assert sorted(r["v"] for r in sinks.upserted(batch, batch, ["k"]).collect()) == [2, 3, 4]


def test_overwrite_from_itself(spark):
    path = tempfile.mkdtemp(prefix="tillhouse-") + "/t"
    sinks.overwrite_table(spark.range(5).toDF("x"), path)
    sinks.overwrite_table(sinks.read_table(spark, path).where("x > 2"), path)
    assert sinks.read_table(spark, path).count() == 2


def test_a_failed_rebuild_leaves_the_table_as_it_was(spark):
    path = tempfile.mkdtemp(prefix="tillhouse-") + "/t"
    assert not sinks.table_exists(spark, path)
    sinks.overwrite_table(spark.range(5).toDF("x"), path)
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception, match="lost"):
        sinks.overwrite_table(broken, path)
    assert sinks.table_exists(spark, path) and sinks.read_table(spark, path).count() == 5
    sinks.overwrite_table(spark.range(7).toDF("x"), path)
    sinks.overwrite_table(spark.range(8).toDF("x"), path)
    assert sinks.read_table(spark, path).count() == 8
    assert len([p for p in os.listdir(path) if p.startswith("v")]) == 2


def test_an_upsert_leaves_no_scratch_copies(spark):
    from tillhouse.session import shared_folder

    path = tempfile.mkdtemp(prefix="tillhouse-") + "/t"
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, day int")
    sinks.incremental_upsert(spark, path, rows, ["k"], "day")
    before = set(os.listdir(shared_folder(spark)))
    sinks.incremental_upsert(spark, path, rows, ["k"], "day")
    assert set(os.listdir(shared_folder(spark))) == before


def test_schema_drift():
    want, have = schemas.struct("a int, b string"), schemas.struct("a bigint, c string")
    assert incremental.schema_drift(want, have) == ["missing column b", "new column c", "column a: int became bigint"]
    assert incremental.schema_drift(want, schemas.struct("b string, a int")) == []


def test_assert_schema(spark):
    with pytest.raises(ValueError, match="out of sync"):
        incremental.assert_schema(spark.range(1), schemas.struct("x bigint"))


def test_whole_run_twice(spark):
    """Two dated batches through all layers, the second one repeated."""
    from tillhouse.plans.daily_run import Batch, Lake, run
    from tillhouse.sources import standin

    root = tempfile.mkdtemp(prefix="tillhouse-")
    lines = standin.raw_transactions(spark, SF_DIR)
    cut = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    customers = standin.raw_customers(spark, SF_DIR)

    def batch(rows, people):
        return Batch(people, standin.raw_products(spark, SF_DIR), standin.raw_stores(spark, SF_DIR), rows, standin.zip_lookup(spark, SF_DIR))

    first = RunContext(run_ts=dt.datetime(2001, 12, 30, 6), batch_id="b1")
    second = RunContext(run_ts=dt.datetime(2001, 12, 31, 6), batch_id="b2")
    odd = F.crc32(c("customer_id").cast("string")) % 2 == 1
    moved = customers.withColumn("city", F.when(odd, F.concat(c("city"), F.lit(" North"))).otherwise(c("city")))
    moved = moved.withColumn("customer_segment", F.when(odd, c("customer_segment")).when(c("customer_segment") == "VIP", "Budget").otherwise("VIP"))
    run(spark, root, batch(lines.where(c("data_created_modified") < cut), customers), first, enforce_gates=False, grain="YEAR")
    lake = Lake(spark, root)
    before = lake.read("fact_sales").count()
    run(spark, root, batch(lines, moved), second, enforce_gates=False, grain="YEAR")
    counts = {t: lake.read(t).count() for t in ("stg_transactions", "intmd_transactions", "fact_sales", "dim_customers")}
    assert counts["fact_sales"] > before
    for table, key in (("dim_customers", "customer_id"), ("dim_products", "product_id"), ("dim_stores", "store_id")):
        current = lake.read(table).where("is_current")
        assert current.count() == current.select(key).distinct().count()
    fact = lake.read("fact_sales")
    assert fact.count() == fact.select("sales_key").distinct().count() == counts["intmd_transactions"]
    history = lake.read("dim_customers").where("not is_current")
    assert history.count() > 0 and history.where("valid_end_date is null").count() == 0
    # A change outside the published hash opens a version too.
    both = history.alias("h").join(lake.read("dim_customers").where("is_current").alias("n"), "customer_id")
    segments = both.where(c("h.customer_segment") != c("n.customer_segment")).select("customer_id").distinct()
    assert segments.count() > 0 and segments.where(odd).count() == 0

    run(spark, root, batch(lines, moved), second, enforce_gates=False, grain="YEAR")
    assert {t: lake.read(t).count() for t in counts} == counts
    assert lake.read("gold_metrics_log").count() == 2 and lake.published().read("fact_sales").count() == lake.read("fact_sales").count()


def test_gate_stops_the_run(spark):
    from tillhouse.plans.daily_run import Batch, Lake, run
    from tillhouse.sources import standin

    root = tempfile.mkdtemp(prefix="tillhouse-")
    broken = standin.raw_transactions(spark, SF_DIR).withColumn("date", F.lit("")).withColumn("total_amount", F.lit(0.0))
    batch = Batch(
        standin.raw_customers(spark, SF_DIR), standin.raw_products(spark, SF_DIR), standin.raw_stores(spark, SF_DIR), broken,
        standin.zip_lookup(spark, SF_DIR),
    )
    assert run(spark, root, batch, RunContext(), grain="YEAR") == {"staging": False}
    assert not Lake(spark, root).has("intmd_transactions")


DAYS = [dt.date(2024, 1, i) for i in range(1, 9)]


def spoil(path, keep):
    """Make the files of all partitions but ``keep`` unreadable."""
    for day in DAYS:
        if day not in keep and os.path.isdir(f"{path}/day={day}"):
            for name in os.listdir(f"{path}/day={day}"):
                if name.endswith(".parquet"):
                    with open(f"{path}/day={day}/{name}", "wb") as f:
                        f.write(b"not parquet")
                    crc = f"{path}/day={day}/.{name}.crc"
                    if os.path.exists(crc):
                        os.unlink(crc)


@pytest.mark.parametrize("old_table", [False, True])
def test_an_upsert_opens_only_partitions_its_filters_name(spark, old_table):
    import shutil

    from tillhouse.sources import keyfilters

    path = tempfile.mkdtemp(prefix="tillhouse-") + "/t"
    rows = spark.range(4000).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.lit(1).alias("v"), F.expr("date_add(date'2024-01-01', cast(id % 8 as int))").alias("day"))
    sinks.incremental_upsert(spark, path, rows, ["k"], "day")
    if old_table:  # a table from before there were filters
        shutil.move(f"{path}/{keyfilters.FOLDER}", tempfile.mkdtemp(prefix="tillhouse-"))
    batch = spark.createDataFrame([("k9", 2, DAYS[4]), ("new", 2, DAYS[4]), ("k12", 2, DAYS[4])], "k string, v int, day date")  # k9 stood on the 2nd, k12 on the 5th
    named = sinks.partitions_with_keys(spark, path, batch, ["k"], "day")
    assert {DAYS[1], DAYS[4]} <= set(named) and len(named) < 5
    spoil(path, {*named, DAYS[4]})
    sinks.incremental_upsert(spark, path, batch, ["k"], "day")
    got = spark.read.schema(batch.schema).parquet(path).where(c("day").isin(DAYS[1], DAYS[4]))
    assert got.count() == 1001 and got.where("v = 2").count() == 3 and got.where("k = 'k9'").first()["day"] == DAYS[4]
    found = sinks.rows_with_keys(spark, path, spark.createDataFrame([("k9",), ("none",)], "k string"), ["k"], "day", batch.schema)
    assert [tuple(r) for r in found.collect()] == [("k9", 2, DAYS[4])]


def test_filters_never_miss_a_key(spark):
    from tillhouse.sources import keyfilters

    rows = spark.range(60_000).select((F.col("id") * 7919 % 100_003).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("b"), F.expr("case when id < 50000 then 'big' when id < 50010 then 'small' when id < 50011 then null else 'mid' end").alias("p"))
    filters = materialise(keyfilters.key_filters(rows, ["a", "b"], "p"), "filters")
    assert filters.select("level").distinct().count() >= 3
    for p, some in (("big", 500), ("small", 10), (None, 1), ("mid", 100)):
        for row in rows.where(c("p").eqNullSafe(F.lit(p))).limit(some).select("a", "b").collect()[:: max(1, some // 4)]:
            one = spark.createDataFrame([tuple(row)], "a long, b long")
            assert p in [r["p"] for r in keyfilters.partitions_named(filters, one, ["a", "b"], "p").collect()]
    strangers = spark.range(2000).select((F.col("id") + 1_000_000).alias("a"), F.lit(1).cast("long").alias("b"))
    assert keyfilters.partitions_named(filters, strangers, ["a", "b"], "p").count() == 0  # outside every range
    inside = spark.createDataFrame([(3, 9)], "a long, b long")
    assert keyfilters.partitions_named(filters, inside, ["a", "b"], "p").count() <= 1
    keyless = spark.createDataFrame([(None, 1)], "a long, b long")
    assert keyfilters.partitions_named(filters, keyless, ["a", "b"], "p").count() == 0


def test_an_upsert_cut_short_is_repeated_with_the_same_outcome(spark, monkeypatch):
    """The run dies after its filters are added, after the data is in place, and before the filters are replaced."""
    from tillhouse.sources import keyfilters

    ddl = "k string, v int, day date"
    first = spark.createDataFrame([(f"k{i}", 1, DAYS[i % 4]) for i in range(40)], ddl)
    second = spark.createDataFrame([("k1", 2, DAYS[6]), ("k2", 2, DAYS[6]), ("n", 2, DAYS[0])], ddl)
    for broken in ("_drop_partition", "gathered", None):
        path = tempfile.mkdtemp(prefix="tillhouse-") + "/t"
        sinks.incremental_upsert(spark, path, first.where("k <> 'k1' or true"), ["k"], "day")
        only = spark.createDataFrame([("solo", 1, DAYS[5])], ddl)
        sinks.incremental_upsert(spark, path, only, ["k"], "day")
        batch = second.union(spark.createDataFrame([("solo", 2, DAYS[6])], ddl))

        def fail(*args):
            raise RuntimeError("lost")

        with monkeypatch.context() as m:
            m.setattr(*((sinks, broken) if broken else (keyfilters, "replace")), fail)
            with pytest.raises(RuntimeError, match="lost"):
                sinks.incremental_upsert(spark, path, batch, ["k"], "day")
        sinks.incremental_upsert(spark, path, batch, ["k"], "day")
        got = sorted((r["k"], r["v"], r["day"]) for r in spark.read.parquet(path).collect())
        want = {f"k{i}": (1, DAYS[i % 4]) for i in range(40)} | {"k1": (2, DAYS[6]), "k2": (2, DAYS[6]), "n": (2, DAYS[0]), "solo": (2, DAYS[6])}
        assert got == sorted((k, v, d) for k, (v, d) in want.items())
        assert not os.path.isdir(f"{path}/day={DAYS[5]}")


def test_a_partition_column_may_begin_with_v(spark):
    path = tempfile.mkdtemp(prefix="tillhouse-") + "/t"
    for v in (1, 2):
        sinks.incremental_upsert(spark, path, spark.createDataFrame([("a", v, "x"), ("b", v, "y")], "k string, n int, vendor string"), ["k"], "vendor")
    assert sinks.table_exists(spark, path) and sorted(r["n"] for r in spark.read.parquet(path).collect()) == [2, 2]
