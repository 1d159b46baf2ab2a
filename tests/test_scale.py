"""Plans and skew paths: what must hold when the data is large."""

import random

import pytest
from pyspark.sql import functions as F
from tables import SF_DIR

from tillhouse.operators import dedup, ranking
from tillhouse.plans.inputs import Warehouse
from tillhouse.session import materialise

c = F.col


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_prunes_before_the_shuffle(spark):
    text = plan(Warehouse(spark, SF_DIR).intmd_transactions().select("line_item_key"))
    limit, exchange = text.rindex("WindowGroupLimit"), text.index("Exchange hashpartitioning")
    assert text.count("WindowGroupLimit") == 2 and limit > exchange


def test_unused_store_name_costs_no_join(spark):
    text = plan(Warehouse(spark, SF_DIR).sales().groupBy("transaction_date").agg(F.sum("line_total")))
    assert text.count("FileScan parquet") == 2 and "LeftOuter" not in text


def test_scan_reads_only_needed_columns(spark):
    text = plan(Warehouse(spark, SF_DIR).sales().groupBy("transaction_date").agg(F.sum("line_total")))
    assert "l_tax" not in text and "o_orderpriority" not in text and "o_orderstatus" not in text


def test_date_filter_reaches_the_scan(spark):
    from tillhouse.sources.files import table

    text = plan(table(spark, SF_DIR, "orders").where("o_orderdate >= timestamp_ntz'2000-01-01 00:00:00'"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text


@pytest.mark.parametrize("name", ["agg12_daily_revenue", "fct1_fact_sales", "mrt4_customer_metrics", "scd2_products_two_batches", "agg17_transaction_rollup"])
def test_no_python_and_no_cartesian_product(spark, name):
    import __spark_entry__ as entry

    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value and one group; some values are NULL."""
    random.seed(7)
    rows = [
        (i, 500 if i % 3 == 0 else None if i % 11 == 0 else random.randrange(1000), "hot" if i % 3 else f"g{i % 5}" if i % 2 else None, None if i % 5 else i)
        for i in range(3000)
    ]
    return rows, materialise(spark.createDataFrame(rows, "id int, v bigint, g string, u int"), "skewed")


def above(a, b):
    """High to low, NULL last."""
    return a is not None and (b is None or a > b)


@pytest.mark.parametrize("ranges", [None, 1, 40])
def test_ranks_equal_brute_force(skewed, ranges):
    rows, df = skewed
    ranked = ranking.global_ranks(df, {"v": "r", "u": "ru"}, materialise, ranges)
    ranked = ranking.rank_in_group(ranked, "g", "v", "rg", materialise, ranges)
    got = {r["id"]: (r["r"], r["ru"], r["rg"]) for r in ranked.collect()}
    want = {
        i: (1 + sum(above(x[1], v) for x in rows), 1 + sum(above(x[3], u) for x in rows), 1 + sum(above(x[1], v) and x[2] == g for x in rows))
        for i, v, g, u in rows[:300]
    }
    assert len(got) == len(rows) and all(got[i] == w for i, w in want.items())


@pytest.mark.parametrize("ranges", [None, 40])
def test_running_share_equals_brute_force(skewed, ranges):
    rows, df = skewed
    got = {r["id"]: r["s"] for r in ranking.running_share(df.where("v is not null"), "v", "s", materialise, ranges).collect()}
    values = [v for _, v, _, _ in rows if v is not None]
    for i, v, _, _ in rows[:200]:
        if v is not None:
            assert got[i] == pytest.approx(sum(w for w in values if w >= v) / sum(values))


def test_no_rank_sorts_detail_rows_in_one_task(skewed):
    _, df = skewed
    ranked = ranking.rank_in_group(ranking.global_ranks(df, {"v": "r"}, materialise), "g", "v", "rg", materialise)
    assert "SinglePartition" not in plan(ranked)


def test_occurrences_count_null_keys_together(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "x"), (None, "x")], "t string, p string")
    assert sorted(r["occurrences"] for r in dedup.occurrences(df, ["t", "p"]).collect()) == [1, 1, 2, 2]
