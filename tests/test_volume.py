"""What travels and what is stored: plans over large tables must not carry more than they use."""

import datetime as dt
import re

from pyspark.sql import functions as F
from tables import SF_DIR

import __spark_entry__ as entry
from tillhouse.operators import quality as q
from tillhouse.plans import marts, profiles
from tillhouse.plans.inputs import Warehouse
from tillhouse.queries import relational
from tillhouse.session import materialise

c = F.col


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def stored_columns(monkeypatch, module) -> list[list[str]]:
    """The columns of every table a query stores through ``module.materialise``."""
    seen = []
    monkeypatch.setattr(module, "materialise", lambda df, name: seen.append(df.columns) or materialise(df, name))
    return seen


def test_metrics_store_what_they_read_and_look_lines_up_once(spark, monkeypatch):
    seen, lookups = stored_columns(monkeypatch, relational), []
    star = marts.star_lookup
    monkeypatch.setattr(marts, "star_lookup", lambda *a: lookups.append(1) or star(*a))
    row = entry.queries()["agg11_gold_metrics"](spark, SF_DIR).first()
    assert len(lookups) == 1 and max(map(len, seen)) <= 11
    orphans = relational._orphans(Warehouse(spark, SF_DIR)).first()
    assert [row[n] for n in orphans.asDict()] == list(orphans)


def test_orphans_of_the_stored_fact_are_those_of_the_lookup(spark):
    day = dt.datetime(2001, 1, 1)
    lines = spark.createDataFrame([(1, "C1", "P1", "S1"), (2, None, "P9", "S1"), (3, "C1", None, None), (4, "C8", "P1", "S2")], "n int, customer_id string, product_id string, store_id string")
    dim = lambda name, ids: spark.createDataFrame([(i, f"k{i}", 1.0, day, True) for i in ids], f"{name}_id string, {name}_key string, cost_price double, at timestamp_ntz, is_current boolean")
    out = marts.star_lookup(lines, dim("customer", ["C1"]), dim("product", ["P1"]), dim("store", ["S1"]))
    assert out.columns == ["customer_id", "product_id", "store_id", "n", "store_key", "product_key", "cost_price", "customer_key"]
    assert sorted(tuple(r) for r in out.select("n", "customer_key", "product_key", "store_key", "cost_price").collect()) == [
        (1, "kC1", "kP1", "kS1", 1.0), (2, None, None, "kS1", None), (3, "kC1", None, None, None), (4, None, "kP1", None, 1.0)]
    assert tuple(profiles.orphan_counts(out).first()) == (2, 2, 2)


def test_whole_lines_travel_unclassified_and_are_not_shuffled_by_store(spark):
    fact = entry.queries()["fct1_fact_sales"](spark, SF_DIR)
    text = fact._jdf.queryExecution().optimizedPlan().toString()
    assert text.rindex("AS line_item_key") < text.index("Join LeftOuter")  # above the lookups
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024))
    try:
        text = plan(entry.queries()["stg_transactions"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not re.search(r"hashpartitioning\(store_id#\d+, \d+\).*\n.*Generate", text) and "BroadcastHashJoin [store_id" in text


def test_whole_and_narrow_plans_of_the_fact_agree(spark):
    whole, narrow = Warehouse(spark, SF_DIR, whole=True).fact(), Warehouse(spark, SF_DIR).fact()
    assert whole.columns == narrow.columns and whole.exceptAll(narrow).isEmpty() and narrow.exceptAll(whole).isEmpty()


def test_checks_read_only_the_columns_they_name(spark):
    df = spark.createDataFrame([(1, 2, "x", 3, 4)], "a int, b int, Note string, c int, unused int")
    checks = [q.not_null("a"), q.unique("b"), q.expression("c", ">= 0", "note is not null")]
    assert q.columns_read(df, checks) == ["a", "b", "Note", "c"]


def test_a_suite_stores_only_checked_columns(spark, monkeypatch):
    from tillhouse.queries import quality

    seen = stored_columns(monkeypatch, quality)
    entry.queries()["suite_fact_sales"](spark, SF_DIR)
    assert sorted(seen[0]) == ["data_quality_status", "is_refund", "line_profit", "line_total", "product_key", "sales_key", "transaction_id", "transaction_type"]


def test_master_data_is_cleaned_by_more_tasks_than_its_file_has_row_groups(spark):
    for name, key in (("customers", "c_custkey"), ("products", "p_partkey")):
        assert f"hashpartitioning({key}" in plan(Warehouse(spark, SF_DIR).raw(name))


def test_the_profile_stores_no_line_key(spark, monkeypatch):
    seen = stored_columns(monkeypatch, relational)
    entry.queries()["agg3_intermediate_profile"](spark, SF_DIR)
    assert "line_item_key" not in seen[0] and {"transaction_id", "product_id"} <= set(seen[0])


def test_daily_files_are_landed_without_shuffling_wide_lines(spark, monkeypatch):
    from tillhouse.sources import sinks

    moved = []
    monkeypatch.setattr(sinks, "gathered", lambda df, partition: moved.append(partition) or df)
    assert entry.queries()["src2_scan_daily_files"](spark, SF_DIR).count() > 0 and not moved


def test_key_filters_shuffle_no_rows_and_sort_no_row_per_bit(spark):
    from tillhouse.sources import keyfilters

    rows = spark.createDataFrame([(f"k{i}" if i else None, i % 2 or None) for i in range(60)], "k string, p int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = keyfilters.key_filters(rows, ["k"], "p")
        text = plan(built)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in text and text.count("Generate") == 1 and text.index("Generate") < text.index("partial_bitmap_construct_agg")
    found = sorted((tuple(r) for r in built.select("p", "low", "high", "empty", F.bitmap_count("bits")).collect()), key=str)
    at = [F.pmod(F.xxhash64(F.xxhash64("k"), F.lit(i)), F.lit(keyfilters.BLOCK_BITS)) for i in range(keyfilters.HASHES)]
    each = rows.select("p", "k", F.explode(F.array(*at)).alias("at")).groupBy("p").agg(
        F.min("k"), F.max("k"), F.bool_or(c("k").isNull()), F.countDistinct("at"))
    assert found == sorted((tuple(r) for r in each.collect()), key=str)


def test_an_upsert_asks_filters_only_where_key_ranges_meet(spark, monkeypatch, tmp_path):
    from tillhouse.sources import keyfilters, sinks

    asked, ask = [], keyfilters.partitions_named
    monkeypatch.setattr(keyfilters, "partitions_named", lambda *a: asked.append(1) or ask(*a))
    names, store = [], sinks.materialise
    monkeypatch.setattr(sinks, "materialise", lambda df, name: names.append(name) or store(df, name))
    frame = lambda rows: spark.createDataFrame(rows, "k string, v int, p string")
    held = lambda: sorted((tuple(r) for r in spark.read.parquet(path).select("k", "v", "p").collect()), key=str)
    path = f"{tmp_path}/t"
    sinks.incremental_upsert(spark, path, frame([("a", 1, "x"), ("b", 1, "x"), (None, 1, "y")]), ["k"], "p", stored=True)
    sinks.incremental_upsert(spark, path, frame([("m", 2, "z"), ("m", 3, "z")]), ["k"], "p", stored=True)
    assert not asked and "upsert-batch" not in names
    assert held() == sorted([("a", 1, "x"), ("b", 1, "x"), (None, 1, "y"), ("m", 2, "z"), ("m", 3, "z")], key=str)
    sinks.incremental_upsert(spark, path, frame([("b", 4, "z"), (None, 4, "z"), ("m", 4, None)]), ["k"], "p")
    assert asked == [1] and held() == sorted([("a", 1, "x"), ("b", 4, "z"), (None, 4, "z"), ("m", 4, None)], key=str)


def test_keys_travel_packed_and_come_back_whole(spark):
    texts = ["900150983cd24fb0d6963f7d28e17f72", "900150983CD24FB0D6963F7D28E17F72", "kC1", "", None, "sixteen bytes ok", "Zoë", "0" * 33]
    df = spark.createDataFrame([(t,) for t in texts], "k string").withColumn("p", marts.packed_key(c("k")))
    out = df.select("k", marts.unpacked_key(c("p")).alias("back"), F.octet_length("p").alias("n")).collect()
    assert all(r["k"] == r["back"] for r in out) and out[0]["n"] == 16 and all(r["n"] != 16 for r in out[1:])
    day = dt.date(2001, 1, 1)
    rows = [("k1", "t1", texts[0], day, 1.0, 1.0, 1, False), ("k1", "t1", "b", day, 2.0, 1.0, 1, False), (texts[0], "t2", "b", day, 3.0, 1.0, 1, False), ("k1", "t3", "x", day, 9.0, 1.0, 1, True)]
    sold = spark.createDataFrame(rows, "product_key string, transaction_id string, customer_key string, transaction_date date, line_total double, line_profit double, quantity bigint, is_refund boolean")
    totals = marts._totals(sold, "product_key")
    assert sorted(tuple(r) for r in totals.select("product_key", "revenue_cents", "total_transactions", "buyers").collect()) == [(texts[0], 300, 1, 1), ("k1", 300, 1, 2)]
    assert "hashpartitioning(product_key" not in plan(totals)


def test_the_consistency_check_looks_up_and_stores_sales_only(spark, monkeypatch):
    refunds = []
    monkeypatch.setattr(relational, "materialise", lambda df, name: refunds.append(df.where("is_refund").count()) or materialise(df, name))
    assert entry.queries()["mrt5_revenue_consistency"](spark, SF_DIR).first()["consistent"] and refunds == [0]
