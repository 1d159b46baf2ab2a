"""Rules find rows that were altered, and only those."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from tables import SF_DIR

from tillhouse.plans import rules
from tillhouse.plans.inputs import Warehouse

c = F.col


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse(spark, SF_DIR)


def altered(df, rule, changes, key):
    """Ids the rule reports once about every third row is altered, against those altered, less what it reports anyway."""
    chosen = F.crc32(F.concat_ws("|", *[c(k).cast("string") for k in key])) % 3 == 0
    df = df.dropDuplicates(key)
    before = {tuple(r[k] for k in key) for r in rule(df).collect()}
    hit = df.where(chosen)
    for name, value in changes.items():
        hit = hit.withColumn(name, value)
    hit = hit.select(*df.columns)
    after = {tuple(r[k] for k in key) for r in rule(df.where(~chosen).unionByName(hit)).collect()}
    picked = {tuple(r) for r in df.where(chosen).select(*key).collect()}
    return after - before, picked - before


def test_profit(wh):
    sold = wh.fact().where("total_cost > 0 and line_total <> 0 and not is_refund")
    got, want = altered(sold, rules.profit_mismatch, {"line_profit": c("line_profit") + 0.05}, ["sales_key"])
    assert got == want != set()
    small, _ = altered(sold, rules.profit_mismatch, {"line_profit": c("line_profit") + 0.01}, ["sales_key"])
    assert small == set()


def test_totals(wh):
    priced = wh.stg_transactions().where("subtotal + tax_amount - total_amount is not null")
    got, want = altered(priced, rules.total_mismatch, {"tax_amount": c("tax_amount") + 0.5}, ["transaction_id_clean"])
    assert got == want != set()


def test_refund_reason(wh):
    refunds = wh.stg_transactions().where("payment_status = 'REFUNDED' and trim(refund_reason) <> ''")
    got, want = altered(refunds, rules.refunds_without_reason, {"refund_reason": F.lit("  ")}, ["transaction_id_clean"])
    assert got == want != set()


@pytest.mark.parametrize("flag", ["has_promotion", "is_refund", "is_weekend"])
def test_flags(wh, flag):
    lines = wh.intmd_transactions().where(f"{flag} is not null and transaction_date is not null and payment_status is not null")
    got, want = altered(lines, rules.flag_disagreements, {flag: ~c(flag)}, ["transaction_id", "product_id"])
    assert got == want != set()


def test_discount(wh):
    lines = wh.stg_transactions().where("discount_amount is not null")
    got, want = altered(lines, rules.discount_mismatch, {"discount_amount": c("discount_amount") - 0.25}, ["transaction_id_raw", "product_id"])
    assert got == want != set()


def test_clean_totals(wh):
    lines = wh.intmd_transactions().where("line_total_clean is not null")
    got, want = altered(lines, rules.clean_total_mismatch, {"line_total_clean": c("line_total_clean") + 1}, ["line_item_key"])
    assert got == want != set()
    mended = lines.where("line_total <> line_total_clean")
    got, want = altered(mended, rules.clean_total_mismatch, {"line_total_clean": c("line_total")}, ["line_item_key"])
    assert got == want


def test_ages_and_margins(wh):
    known = wh.stg_customers().where("age is not null and date_of_birth is not null")
    got, want = altered(known, rules.age_mismatch, {"age": c("age") + 2}, ["customer_id"])
    assert got >= want != set()
    priced = wh.stg_products().where("profit_margin_pct is not null")
    got, want = altered(priced, rules.margin_mismatch, {"profit_margin_pct": c("profit_margin_pct") + 0.5}, ["product_id"])
    assert got == want != set()


def test_labels(wh):
    def reported(customers, products, stores):
        return {(r["id"], r["label"]) for r in rules.label_disagreements(customers, products, stores).collect()}

    tables = wh.intmd_customers().dropDuplicates(["customer_id"]), wh.stg_products().dropDuplicates(["product_id"]), wh.intmd_stores().dropDuplicates(["store_id"])
    before = reported(*tables)
    for i, (key, label) in enumerate([("customer_id", "quality_tier"), ("product_id", "weight_category"), ("store_id", "region"), ("store_id", "store_category")]):
        changed = list(tables)
        changed[i if i < 3 else 2] = changed[i if i < 3 else 2].withColumn(label, F.concat(label, F.lit("?")))
        ids = {(r[0], label) for r in tables[i if i < 3 else 2].select(key).collect()}
        assert reported(*changed) == before | ids


def test_repeated_names(spark):
    people = spark.createDataFrame([("C1", "a@b.com"), ("C2", "a@b.com"), ("C3", None), ("C4", None), ("C5", "x@y.org")], "customer_id string, email string")
    assert [tuple(r) for r in rules.repeated_emails(people).collect()] == [("a@b.com", 2)]
    shops = spark.createDataFrame([("Mall", "Rome"), ("Mall", "Rome"), ("Mall", "Oslo"), ("Shop", "Oslo")], "store_name string, city string")
    assert [tuple(r) for r in rules.repeated_store_names(shops).collect()] == [("Mall", "Rome", 2)]


def test_calendar_holes(spark):
    days = [dt.date(2001, 1, 1) + dt.timedelta(n) for n in range(20) if n not in (3, 4, 11)]
    held = spark.createDataFrame([(d,) for d in days], "date_actual date")
    got = {r["expected_date"].day for r in rules.calendar_gaps(held, dt.date(2001, 1, 1), 20).collect()}
    assert got == {4, 5, 12}
