"""Profiles brought forward by batches equal those of the whole table."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tillhouse.plans import profiles
from tillhouse.plans.profile_state import ProfileState
from tillhouse.sources import sinks

STAGED = (
    "staging_processed_at timestamp_ntz, transaction_date date, transaction_id_clean string, transaction_id_raw string, product_id string, "
    "customer_id string, store_id string, missing_transaction_id_flag int, missing_date_flag int, missing_customer_id_flag int, "
    "missing_product_id_flag int, negative_quantity_flag int, negative_amount_flag int, zero_total_amount_flag int, zero_quantity_flag int, "
    "high_unit_price_flag int, line_total double, quantity bigint, total_amount double, is_refund boolean, has_promotion boolean, part date"
)
REFINED = (
    "intermediate_processed_at timestamp_ntz, line_item_key string, transaction_id string, customer_id string, product_id string, store_id string, "
    "data_quality_status string, line_total_clean double, quantity_clean bigint, total_amount double, is_refund boolean, has_promotion boolean, "
    "has_discount boolean, is_bulk_purchase boolean, is_high_value_item boolean, transaction_type string, is_weekend boolean, time_of_day string, "
    "discount_percent double, discount_amount double, payment_method string, earned_loyalty_points boolean, loyalty_points_earned bigint, part date"
)


def some(rng, *values):
    return rng.choice(values)


def staged_line(rng, day, txn, product):
    bit = lambda: rng.randrange(2)
    flags = [bit() for _ in range(9)]
    amount = some(rng, None, round(rng.uniform(-50, 500), 2))
    return (dt.datetime(2024, 1, day, rng.randrange(24)), some(rng, None, dt.date(2023, rng.randrange(1, 13), 3)), txn, some(rng, "a", "b"), product,
            some(rng, None, "c1", "c2", "c3"), some(rng, "s1", "s2"), *flags, amount, some(rng, None, rng.randrange(-3, 9)), some(rng, 10.5, 20.25, None), bool(bit()), bool(bit()),
            dt.date(2023, 1 + hash((txn, 7)) % 3 if txn else 1, 1))


def refined_line(rng, day, txn, product):
    yes = lambda: some(rng, None, True, False)
    return (dt.datetime(2024, 1, day, 5), f"{txn}|{product}", txn, some(rng, None, "c1", "c2"), product, some(rng, "s1", "s2"), some(rng, "CLEAN", "CORRECTED", "INCOMPLETE"),
            some(rng, None, 9.99, 0.1), some(rng, None, 1, 2), some(rng, 5.5, 7.0), *[yes() for _ in range(5)], some(rng, "Regular Sale", "Promotion", "Refund"), yes(),
            some(rng, "Morning", "Late Evening"), some(rng, None, 5.0), some(rng, None, 0.35), some(rng, "Cash", "Card"), yes(), some(rng, None, 3),
            dt.date(2023, 1 + len(product), 1))


CASES = {
    "staging": (profiles.StagingLayer, STAGED, staged_line, ["transaction_id_clean", "product_id", "transaction_id_raw"]),
    "intermediate": (profiles.IntermediateLayer, REFINED, refined_line, ["line_item_key"]),
}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", sorted(CASES))
def test_batches_bring_a_profile_forward(spark, name, monkeypatch):
    layer, ddl, line, keys = CASES[name]
    rng = random.Random(3)
    area = tempfile.mkdtemp(prefix="tillhouse-")
    state = ProfileState(spark, f"{area}/state", layer(), f"{area}/t")
    transactions = [f"T{i}" for i in range(12)] + ([None] if name == "staging" else [])
    products = ["p", "pp", None] if name == "staging" else ["p", "pp"]
    at = ddl.split(",")[0].split()[0]
    for day in (3, 4, 9, 2):  # later, and a late one
        batch = [line(rng, day, rng.choice(transactions), rng.choice(products)) for _ in range(25)]
        if name == "intermediate":
            batch = list({r[1]: r for r in batch}.values())
        df = spark.createDataFrame(batch, ddl)
        for _ in range(1 + (day == 2)):  # a batch repeated changes nothing
            state.begin()
            sinks.incremental_upsert(spark, f"{area}/t", df, keys, "part", [layer.transaction], state.apply)
        table = spark.read.schema(df.schema).parquet(f"{area}/t")
        assert rows(state.profile()) == rows(layer().finish(layer().figures(table)))
        monkeypatch.setattr(ProfileState, "rebuild", lambda *a: pytest.fail("counted the whole table"))
    assert table.select(F.col(at).cast("date")).distinct().count() >= 3


def test_a_run_cut_short_is_counted_anew(spark):
    layer, ddl, line, keys = CASES["staging"]
    rng = random.Random(5)
    area = tempfile.mkdtemp(prefix="tillhouse-")
    state = ProfileState(spark, f"{area}/state", layer(), f"{area}/t")
    for day in (1, 2, 3):
        df = spark.createDataFrame([line(rng, day, f"T{i % 5}", "p") for i in range(9)], ddl)
        state.begin()
        sinks.incremental_upsert(spark, f"{area}/t", df, keys, "part", [layer.transaction], None if day == 2 else state.apply)  # lost on the 2nd
        if day != 2:
            assert rows(state.profile()) == rows(layer().finish(layer().figures(spark.read.schema(df.schema).parquet(f"{area}/t"))))
