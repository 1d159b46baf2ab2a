"""How lines are dealt out: once, as they were read, and only for lookups that are used."""

import datetime as dt
import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from tables import SF_DIR

import __spark_entry__ as entry
from tillhouse.operators import dedup
from tillhouse.operators import quality as q
from tillhouse.plans import marts, profiles
from tillhouse.plans.inputs import Warehouse
from tillhouse.session import materialise

c = F.col
AT = dt.datetime(2001, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df) -> list[str]:
    return sorted(str(tuple(r)) for r in df.collect())


def exchanged(df) -> list[str]:
    """What lies right below each shuffle that lines were dealt out by."""
    lines = plan(df).splitlines()
    return [lines[i + 1] for i, x in enumerate(lines) if "REPARTITION_BY_COL" in x and ("_product" in x or "_transaction" in x)]


def test_whole_lines_travel_as_they_were_read(spark):
    for name in ("fct1_fact_sales", "intmd_transactions"):
        (below,) = exchanged(entry.queries()[name](spark, SF_DIR))
        assert "l_extendedprice" in below and "payment" not in below and "Supplier#" not in below


def test_whole_lines_are_not_shuffled_by_store(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(16 * 1024))
    try:
        text = plan(entry.queries()["fct1_fact_sales"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [store_id" not in text and "BroadcastHashJoin [store_id" in text
    assert "SortMergeJoin [_product" in text and text.count("SortMergeJoin [customer_id") == 1


def test_lookups_that_nobody_reads_are_dropped(spark):
    text = plan(entry.queries()["mrt4_customer_metrics"](spark, SF_DIR))
    assert "part.parquet" not in text and "p_partkey" not in text and "s_suppkey" not in text and "customer_id" in text
    sold = Warehouse(spark, SF_DIR).fact().select("sales_key", "line_profit")
    assert "c_custkey" not in plan(sold) and "p_partkey" in plan(sold)


def staged(spark):
    """Copies and rivals of lines; one product has most of them, some lines lack an id."""
    line = lambda t, p, n, raw=None, refund=False: (t, p, raw or t, AT, refund, AT + dt.timedelta(n % 3), n, 1.0 * n, 2.0, 3.0, "C1", f"S{n}")
    rows = [line(f"T{i % 40}", "hot", i, f"DUPT{i % 40}" if i % 2 else None) for i in range(120)]
    rows += [line(f"T{i}", f"P{i % 3}", i, refund=bool(i % 2)) for i in range(9)] + [line(None, "hot", 1), line("T1", None, 2), line(None, None, 3), line("T1", None, 2)]
    return spark.createDataFrame(rows, "transaction_id_clean string, product_id string, transaction_id_raw string, staging_processed_at timestamp_ntz, "
                                 "is_refund boolean, raw_loaded_at timestamp_ntz, quantity int, unit_price double, line_total double, total_amount double, customer_id string, store_id string")


def test_lines_dealt_out_keep_the_same_winners(spark):
    df = staged(spark)
    want = dedup.latest_line(df).where("transaction_id_clean is not null and product_id is not null")
    for deal, by in ((dedup.dealt_by_product, dedup.DEALT), (dedup.dealt_by_transaction, dedup.DEALT_TRANSACTION)):
        dealt = deal(df, c("transaction_id_clean"), c("product_id"))
        found = dedup.latest_line(dealt, by)
        assert rows_of(found.drop(*by)) == rows_of(want)
        assert plan(found).count("Exchange hashpartitioning") == 1
    places = dedup.dealt_by_product(df, c("transaction_id_clean"), c("product_id")).where("product_id = 'hot'").select("_salt").distinct()
    assert places.count() == dedup.SALTS


def test_dealt_lines_meet_the_same_dimension_rows(spark):
    lines = dedup.latest_line(staged(spark)).where("transaction_id_clean is not null and product_id is not null")
    dim = lambda name, ids: spark.createDataFrame([(i, f"k{i}", 1.5, AT, True) for i in ids], f"{name}_id string, {name}_key string, cost_price double, at timestamp_ntz, is_current boolean")
    dims = dim("customer", ["C1"]), dim("product", ["hot", "P1"]), dim("store", ["S1", "S2"])
    want = marts.star_lookup(lines, *dims)
    found = marts.star_lookup(dedup.dealt_by_product(lines, c("transaction_id_clean"), c("product_id")), *dims)
    assert found.columns == want.columns and rows_of(found) == rows_of(want)
    assert found.where("product_key = 'khot'").count() == 40


def test_days_of_the_revenue_mart_are_counted_once(spark, monkeypatch):
    names = []
    monkeypatch.setattr(marts, "materialise", lambda df, name: names.append(name) or materialise(df, name))
    out = entry.queries()["mrt1_revenue_performance"](spark, SF_DIR)
    assert "daily-sales" in names and "lineitem" not in plan(out) and out.count() > 0


def test_line_keys_are_counted_packed(spark):
    keys = ["0" * 32, "A" * 32, None, "k1", "k1", ""]
    rows = [(AT, f"t{i // 2}", f"p{i}", k, 1.0, 1) for i, k in enumerate(keys)]
    lines = spark.createDataFrame(rows, "profile_date timestamp_ntz, transaction_id string, product_id string, line_item_key string, total_amount double, w bigint")
    unique, _ = profiles.IntermediateLayer().per_transaction(lines)
    assert "unhex" in plan(unique) and tuple(unique.first()) == (AT, 5, 3)


def test_uniqueness_is_counted_over_packed_keys(spark):
    keys = ["ab" * 16, "AB" * 16, "ab" * 16, "", "", None, None, "x"]
    df = spark.createDataFrame([(k, i % 2) for i, k in enumerate(keys)], "k string, m int")
    out = q.run_checks(df, [q.unique("k"), q.unique("k", "m")], AT)
    assert "unhex" in plan(out) and {r["check"]: r["failures"] for r in out.collect()} == {"unique(k)": 2, "unique(k, m)": 1}


def test_what_is_stored_on_the_way_is_packed_tightly(spark):
    stored = materialise(spark.range(10), "tight")
    (file,) = glob.glob(f"{stored.scratch}/*.parquet".replace("file:", ""))[:1]
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
