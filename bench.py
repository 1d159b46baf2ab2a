"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is planned, run and its whole result written to the no-op sink.  A
short warm-up on the same queries is not counted: it loads classes and compiles
code, which a long-lived session does once.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tillhouse.queries import load_all  # noqa: E402
from tillhouse.session import local_session  # noqa: E402

HEADLINE = [
    "agg12_daily_revenue", "agg13_store_month_revenue", "agg14_top_categories", "agg17_transaction_rollup", "agg22_daily_summary",
    "stg_transactions", "win1_dedup_latest_line", "fct1_fact_sales", "agg1_staging_profile", "agg3_intermediate_profile",
    "scd2_customers_two_batches", "mrt1_revenue_performance", "mrt2_store_performance", "mrt3_products_performance",
    "mrt4_customer_metrics", "suite_stg_transactions", "win8_global_ranks", "str5_live_store_figures",
]


def timed(fn, spark, sf_dir: str) -> float:
    start = time.time()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.time() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    queries = load_all()
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in names:
            timed(queries[name], spark, small)
    seconds = {name: timed(queries[name], spark, sf_dir) for name in names}
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
