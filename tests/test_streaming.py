"""The stream in several micro-batches equals the batch result."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tillhouse.plans import suites
from tillhouse.streaming import live
from tillhouse.streaming.figures import FigureStore

c = F.col


def message(txn, product, time, total="10.00", store="ST-1", **more):
    return json.dumps({
        "transaction_id": txn, "product_id": product, "date": time[:10], "datetime": time, "store_id": store, "total_amount": total,
        "items_count": "2", "quantity": "1", "line_total": "5.00", **more,
    })


def topic(spark, batches):
    path = tempfile.mkdtemp(prefix="tillhouse-") + "/topic"
    for rows in batches:
        df = spark.createDataFrame([(r,) for r in rows], "value string").withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(path)
    return live.file_messages(spark, path, files_per_trigger=1)


BATCHES = [
    [message("T1", "A", "2024-01-01 10:00:00"), message("T1", "B", "2024-01-01 10:00:00"), message("DUPT1", "A", "2024-01-01 10:00:00")],
    [message("T1", "A", "2024-01-01 10:00:00"), message("T2", "A", "2024-01-01 10:20:00", total="oops")],
    [message("T3", "A", "2024-01-02 09:00:00", store="ST-2")],
    [message("T4", "A", "2024-01-02 09:30:00"), message("T3", "A", "2024-01-02 09:00:00", store="ST-2")],
]


def test_figures_over_micro_batches(spark):
    area = tempfile.mkdtemp(prefix="tillhouse-")
    stores = spark.createDataFrame([("ST-1", "One")], "store_id string, store_name string")
    figures = live.live_figures(topic(spark, BATCHES), stores)
    live.write_figures(figures, f"{area}/figures", f"{area}/cp", available_now=True, fold_every=3).awaitTermination()
    got = {(str(r["window_start"])[:10], r["store_name"]): (r["transactions"], r["total_sales"], r["avg_basket"])
           for r in live.with_averages(live.read_figures(spark, f"{area}/figures")).collect()}
    assert got == {("2024-01-01", "One"): (2, 10.0, 10.0), ("2024-01-02", None): (1, 10.0, 10.0), ("2024-01-02", "One"): (1, 10.0, 10.0)}
    totals = {str(r["window_start"])[:10]: tuple(r)[1:] for r in live.window_totals(live.read_figures(spark, f"{area}/figures")).collect()}
    assert totals["2024-01-02"] == (2, 20.0, 1, 10.0)


def folded(spark, path):
    store = FigureStore(spark, path, 2)
    return store, lambda: {(r["window_start"].minute, r["store_name"]): (r["transactions"], r["total_sales"]) for r in store.current().collect()}


def changed(spark, *rows):
    at = [(dt.datetime(2024, 1, day, 0, minute), store, n, n * 10.0, n, n, n) for minute, store, n, day in rows]
    return spark.createDataFrame(at, "window_start timestamp, store_name string, transactions long, total_sales double, priced long, items long, counted long")


def test_figures_are_a_log_that_is_folded(spark):
    path = tempfile.mkdtemp(prefix="tillhouse-") + "/figures"
    store, now = folded(spark, path)
    store.append(changed(spark, (1, "a", 1, 1), (2, None, 1, 2)), 0)
    assert not os.path.exists(store.base) and now() == {(1, "a"): (1, 10.0), (2, None): (1, 10.0)}
    store.append(changed(spark, (1, "a", 3, 1)), 1)
    assert store.epochs() == [] and now() == {(1, "a"): (3, 30.0), (2, None): (1, 10.0)}  # folded
    store.append(changed(spark, (1, "a", 3, 1)), 1)  # the last epoch again, after a restart
    assert now() == {(1, "a"): (3, 30.0), (2, None): (1, 10.0)}
    store.append(changed(spark, (2, None, 4, 2)), 2)
    assert now() == {(1, "a"): (3, 30.0), (2, None): (4, 40.0)} and store.epochs() == []


def test_a_trigger_reads_nothing_stored(spark):
    path = tempfile.mkdtemp(prefix="tillhouse-") + "/figures"
    store, now = folded(spark, path)
    for epoch in (0, 1):
        store.append(changed(spark, (1, "a", epoch + 1, 1)), epoch)
    for folder, _, names in os.walk(store.base):
        for name in names:
            os.unlink(os.path.join(folder, name))  # whatever the base holds
    store.append(changed(spark, (5, "b", 1, 3)), 2)
    assert store.epochs() == [2]


def test_a_fold_cut_short_loses_and_repeats_nothing(spark, monkeypatch):
    from tillhouse.streaming import figures

    path = tempfile.mkdtemp(prefix="tillhouse-") + "/figures"
    store, now = folded(spark, path)
    store.append(changed(spark, (1, "a", 1, 1), (2, "b", 2, 1)), 0)

    def fail(*args):
        raise RuntimeError("lost")

    for name in ("incremental_upsert", "delete"):
        with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
            m.setattr(figures, name, fail)
            store.append(changed(spark, (1, "a", 5, 1)), 1)
        assert now() == {(1, "a"): (5, 50.0), (2, "b"): (2, 20.0)}
    store.append(changed(spark, (1, "a", 5, 1)), 1)
    assert now() == {(1, "a"): (5, 50.0), (2, "b"): (2, 20.0)} and store.epochs() == []


def test_lines_land_under_their_own_day(spark):
    area = tempfile.mkdtemp(prefix="tillhouse-")
    lines = live.distinct_lines(live.typed_lines(topic(spark, BATCHES)))
    live.write_daily_files(lines, f"{area}/days", f"{area}/cp", available_now=True).awaitTermination()
    rows = spark.read.parquet(f"{area}/days").collect()
    assert sorted((r["transaction_id"], r["product_id"], str(r["file_day"])) for r in rows) == [
        ("T1", "A", "2024-01-01"), ("T1", "B", "2024-01-01"), ("T2", "A", "2024-01-01"), ("T3", "A", "2024-01-02"), ("T4", "A", "2024-01-02"),
    ]
    assert [r["total_amount"] for r in rows if r["transaction_id"] == "T2"] == [None]


def test_restart_does_not_repeat_lines(spark):
    area = tempfile.mkdtemp(prefix="tillhouse-")
    source = topic(spark, BATCHES[:1])
    for _ in range(2):
        live.write_daily_files(live.typed_lines(source), f"{area}/days", f"{area}/cp", available_now=True).awaitTermination()
    assert spark.read.parquet(f"{area}/days").count() == 3


def test_calendar_suite_passes(spark):
    from tillhouse.context import DEFAULT
    from tillhouse.operators.quality import run_checks
    from tillhouse.plans.inputs import Warehouse

    out = run_checks(Warehouse(spark, "/root/testdata/sf0.001").dim_date(), suites.suite("dim_date"), DEFAULT.run_ts)
    assert {r["status"] for r in out.collect()} == {"pass"} and out.count() == 4


def test_suites_hold_the_declared_checks():
    sizes = {t: len(suites.suite(t)) for t in suites.SUITES}
    assert sum(sizes.values()) > 650, sizes
