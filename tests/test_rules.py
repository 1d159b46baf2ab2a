"""Column rules on hand-made edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillhouse.functions import buckets, dates, flags, measures, text

c = F.col


def values(spark, column, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(c("v"))).collect()]


@pytest.mark.parametrize("rule, inputs, expected", [
    (text.strip_non_printable, ["Café", "Acme Mall", "Acme​", " Acme Mall ", None], ["Caf", "AcmeMall", "Acme", "Acme Mall", None]),
    (text.normalize_email, ["A at b.com", "a@@b.com", "plain", "  X@Y.ORG ", "", None], ["a@b.com", "a@@b.com", None, "x@y.org", None, None]),
    (text.phone_extract,
     ["5551234567", "(555)123-4567", "+1-555-123-4567x99", "001-555-123-4567", "555.123.4567x12", "", None],
     ["5551234567", "5551234567", "5551234567", "5551234567", "5551234567", "", None]),
    (text.phone_country_code, ["+1-555", "001-555", "555", None], ["+1", "+1", None, None]),
    (text.phone_extension, ["555x12", "555", "5x1x2", None], ["12", None, "1", None]),
    (text.drop_first_non_digit, ["55-51-2", "555", None], ["5551-2", "555", None]),
    (text.street_from_address, ["1 Main St\nTown, TX 75001", "1 Main St, Town", "1 Main St", "", None], ["1 Main St"] * 3 + [None, None]),
    (dates.safe_date, ["2020-02-29", "2021-02-29", " ", None], [dt.date(2020, 2, 29), None, None, None]),
    (dates.time_or_midnight, ["23:59:59", "24:00:00", "", None], ["23:59:59", None, "00:00:00", "00:00:00"]),
    (dates.hour_of, ["08:30:00", "", None], [8, None, None]),
])
def test_text_and_dates(spark, rule, inputs, expected):
    assert values(spark, rule, inputs) == expected


@pytest.mark.parametrize("rule, inputs, expected", [
    (buckets.age_group, [17, 18, 24, 25, 64, 65, None], ["Under 18", "18-24", "18-24", "25-34", "55-64", "65+", "65+"]),
    (buckets.tenure_by_days, [89, 90, 364, 365, 729, 730, None],
     ["New (< 3 months)", *["Recent (3-12 months)"] * 2, *["Established (1-2 years)"] * 2, *["Loyal (2+ years)"] * 2]),
])
def test_ladders(spark, rule, inputs, expected):
    assert values(spark, rule, inputs, "int") == expected


def test_lifetime_value_differs_by_layer(spark):
    inputs = [-1.0, 0.0, 499.99, 500.0, 2000.0, 5000.0, None]
    common = ["Negative", "Very Low Value", "Very Low Value", "Low Value", "Medium Value", "High Value"]
    assert values(spark, buckets.ltv_tier, inputs, "double") == [*common, "Very Low Value"]
    assert values(spark, buckets.ltv_category, inputs, "double") == [*common, "Negative"]


def test_money_rounds_the_decimal_value(spark):
    assert values(spark, measures.money, [1.005, -0.0, 2.675, None], "double") == [1.01, 0.0, 2.68, None]


def test_boundary_counts(spark):
    df = spark.sql("select date'2023-12-31' a, date'2024-01-01' b")
    row = df.select(dates.years_between(c("a"), c("b")), dates.months_between_boundaries(c("a"), c("b"))).first()
    assert tuple(row) == (1, 1)


def test_sale_corrections(spark):
    rows = [(-2, -10.0, False), (-2, -10.0, True), (3, 0.0, False), (3, 9.0, False)]
    df = spark.createDataFrame(rows, "q bigint, t double, r boolean")
    out = df.select(
        measures.quantity_clean(c("q"), c("r")), measures.line_total_clean(c("t"), c("q"), F.lit(5.0), F.lit(20.0), c("r"))
    ).collect()
    assert [tuple(r) for r in out] == [(2, 0.0), (-2, -10.0), (3, 12.0), (3, 9.0)]


def test_missing_date_comes_from_the_id(spark):
    df = spark.createDataFrame([(None, None, "TXN20240105000001"), ("bad", "10:00:00", "TXN20240105000001"), ("2024-02-01", "10:00:00", "x")], "d string, t string, i string")
    out = df.select(dates.date_or_from_id(c("d"), c("i")), dates.compose_datetime(c("d"), c("t"), c("i"))).collect()
    assert [tuple(r) for r in out] == [
        (dt.date(2024, 1, 5), dt.datetime(2024, 1, 5)), (None, None), (dt.date(2024, 2, 1), dt.datetime(2024, 2, 1, 10)),
    ]


def test_address_with_wildcards_is_compared_literally(spark):
    df = spark.createDataFrame([("1 Main St, A_B", "A_B"), ("1 Main St, AxB", "A_B"), (None, "A"), ("x", None)], "a string, p string")
    assert [r[0] for r in df.select(flags.address_mismatch(c("a"), c("p"))).collect()] == [0, 1, 0, 0]


def test_surrogate_keys(spark):
    import hashlib

    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    row = spark.sql("select 'a' a, cast(null as string) b").select(
        flags.surrogate_key(c("a"), c("b")), flags.unknown_member_key(), flags.unknown_product_key(c("a"))
    ).first()
    assert tuple(row) == (md5("a-_dbt_utils_surrogate_key_null_"), md5("-1"), md5("UNKNOWN-a"))


def test_negative_zero_hashes_like_zero(spark):
    assert values(spark, lambda v: flags.row_hash(flags.as_text(v)), [0.0, -0.0], "double")[0] == values(
        spark, lambda v: flags.row_hash(flags.as_text(v)), [-0.0], "double")[0]


def test_calendar_days(spark):
    from tillhouse.plans.marts import dim_date

    days = ["2020-02-29", "2024-01-01", "2021-01-01", "2023-11-23", "2023-11-22", "2001-12-31"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "date_day date")
    got = {str(r["date_actual"]): r for r in dim_date(df).collect()}
    assert got["2021-01-01"]["week_of_year"] == 53 and got["2024-01-01"]["week_of_year"] == 1
    assert got["2023-11-23"]["holiday_name"] == "Thanksgiving" and not got["2023-11-22"]["is_holiday"]
    assert got["2020-02-29"]["is_last_day_of_month"] and got["2001-12-31"]["is_today"] and got["2024-01-01"]["holiday_name"] == "New Year's Day"


def test_two_clean_spellings_multiply_master_rows_only(spark):
    from tillhouse.plans import staging

    raw = spark.createDataFrame([("P1", "Nut"), ("P1", "Nuts"), ("P2", "Bolt​")], "product_id string, product_name string")
    names = staging.canonical_names(raw, "product_id", "product_name")
    assert sorted(r["clean_name"] for r in raw.join(names, "product_id").collect()) == ["Nut", "Nut", "Nuts", "Nuts"]
    lines = raw.toDF("store_id", "store_name")
    assert [tuple(r) for r in staging.store_name_of_lines(lines).collect()] == [("P1", "Nut")]


def test_days_outside_the_stated_range_are_kept(spark, tmp_path):
    from tillhouse.queries import load_all

    days = [dt.datetime(1994, 12, 30), dt.datetime(1994, 12, 30), dt.datetime(2003, 5, 6), None]
    rows = [(i, d, "1-URGENT") for i, d in enumerate(days)]
    spark.createDataFrame(rows, "o_orderkey long, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    orders = {r["expected_date"]: r["orders"] for r in load_all()["gen2_date_series"](spark, str(tmp_path)).collect()}
    assert {d: n for d, n in orders.items() if n} == {dt.date(1994, 12, 30): 2, dt.date(2003, 5, 6): 1}
    span = {dt.date(1994, 12, 30) + dt.timedelta(n) for n in range((dt.date(2003, 5, 6) - dt.date(1994, 12, 30)).days + 1)}
    assert set(orders) == span
    gaps = {r["expected_date"] for r in load_all()["dq16_calendar_gaps"](spark, str(tmp_path)).collect()}
    assert gaps == span - {dt.date(1994, 12, 30), dt.date(2003, 5, 6)}
