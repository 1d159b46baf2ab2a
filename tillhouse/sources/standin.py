"""Raw retail extracts derived from the given tables.

Row-local expressions only, so every extract grows with its table and costs no
shuffle of its own.  Defects (blank fields, noise characters, duplicate-marked
copies, negative quantities, unknown ids) follow from the keys and are therefore
the same on every read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions.measures import money
from tillhouse.sources.files import table

NBSP, ZWSP, BAD_CHAR = "\u00a0", "\u200b", "\ufffd"


def _pad(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def _pick(key: Column, *values: str | None) -> Column:
    items = [F.lit(v).cast("string") for v in values]
    return F.element_at(F.array(*items), (key % len(values)).cast("int") + 1)


def _day(start: str, offset: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), offset.cast("int")).cast("string")


def _phone(key: Column) -> Column:
    digits = F.lpad(key.cast("string"), 10, "5")
    dashed = F.concat(digits.substr(1, 3), F.lit("-"), digits.substr(4, 3), F.lit("-"), digits.substr(7, 4))
    ext = F.concat(F.lit("x"), (key % 1000).cast("string"))
    form = key % 8
    return (
        F.when(form == 0, digits)
        .when(form == 1, F.concat(F.lit("("), digits.substr(1, 3), F.lit(")"), digits.substr(4, 3), F.lit("-"), digits.substr(7, 4)))
        .when(form == 2, F.concat(F.lit("+1-"), dashed, ext))
        .when(form == 3, F.concat(F.lit("001-"), dashed))
        .when(form == 4, F.concat(F.replace(dashed, F.lit("-"), F.lit(".")), ext))
        .when(form == 5, F.concat(F.lit("001-"), dashed, ext))
        .when(form == 6, F.when(key % 16 == 6, F.lit("")))
        .otherwise(digits.substr(6, 5))
    )


def _address(key: Column, city: Column, state: Column, zip_code: Column) -> Column:
    street = F.concat(key.cast("string"), F.lit(" Main St"))
    rest = F.concat(F.coalesce(city, F.lit("")), F.lit(", "), F.coalesce(state, F.lit("")), F.lit(" "), zip_code)
    form = key % 5
    return (
        F.when(form <= 1, F.concat(street, F.lit("\n"), rest))
        .when(form == 2, F.concat(street, F.lit(", "), F.coalesce(city, F.lit(""))))
        .when(form == 3, street)
        .when(key % 10 == 4, F.lit(""))
    )


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Master data dealt out by key before it is derived.

    A file of a million rows may be a single row group, which only one task can read; the cleaning that follows
    would all be done by that task.
    """
    return df.repartition(key)


def till_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What till lines are derived from, one row per line; about one line in seven also has a 'DUP' copy."""
    line = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    return line.join(orders, k == F.col("o_orderkey")).drop("o_orderkey").withColumn(
        "copy", F.explode(F.when((k + n) % 7 == 0, F.array(F.lit(""), F.lit("DUP"))).otherwise(F.array(F.lit(""))))
    )


def line_ids() -> dict[str, Column]:
    """The transaction and product id of a till line."""
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    return {
        "transaction_id": F.concat(F.col("copy"), F.lit("TXN"), F.date_format("o_orderdate", "yyyyMMdd"), _pad(k, 12)),
        "product_id": F.when((k % 89 == 0) & (n == 1), F.lit(None).cast("string"))
        .when(k % 61 == 0, F.concat(F.lit("INVALID"), _pad(F.col("l_partkey") % 10000, 4)))
        .otherwise(F.concat(F.lit("PRD"), _pad(F.col("l_partkey"), 9))),
    }


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per till line."""
    return raw_of_lines(till_lines(spark, sf_dir))


def raw_of_lines(lines: DataFrame, also: list[str] | None = None) -> DataFrame:
    """The raw extract of :func:`till_lines`, row by row; columns named by ``also`` are passed on."""
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    refund = F.col("l_returnflag") == "R"
    qty = F.col("l_quantity").cast("bigint")
    negative = (refund & (F.col("l_linestatus") == "F")) | ((F.col("l_returnflag") == "A") & (k % 29 == 0))
    price = money(F.col("l_extendedprice") / F.col("l_quantity"))
    pct = F.round(F.col("l_discount") * 400).cast("bigint").cast("double")
    date_text = F.date_format("o_orderdate", "yyyy-MM-dd")
    clock = F.concat(_pad(k % 15 + 8, 2), F.lit(":"), _pad(F.col("l_partkey") % 60, 2), F.lit(":00"))
    has_time = (k % 20 != 0) & (k % 20 != 5)
    ids = line_ids()

    df = lines.withColumn("qty", F.when(negative, -qty).otherwise(qty)).withColumn("price", price).withColumn("pct", pct)
    total = F.when(k % 41 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice"))
    return df.select(
        ids["transaction_id"].alias("transaction_id"),
        F.when(k % 40 == 1, F.lit("")).when(k % 40 != 0, date_text).alias("date"),
        F.when(k % 20 == 5, F.lit("")).when(k % 20 != 0, clock).alias("time"),
        F.when(has_time, F.concat(date_text, F.lit(" "), clock)).alias("datetime"),
        F.when(k % 97 != 0, F.concat(F.lit("CUST"), _pad(F.col("o_custkey"), 9))).alias("customer_id"),
        F.concat(F.lit("ST"), _pad(F.col("l_suppkey"), 6)).alias("store_id"),
        F.concat(F.lit("Supplier#"), _pad(F.col("l_suppkey"), 9), F.when(n % 5 == 0, F.lit(ZWSP)).otherwise(F.lit(""))).alias("store_name"),
        F.when(F.col("l_tax") != 0, F.concat(F.lit("EMP"), _pad(k % 500, 4))).alias("cashier_id"),
        F.col("o_orderpriority").alias("payment_method"),
        money(total * 0.92).alias("subtotal"),
        money(total * 0.08).alias("tax_amount"),
        total.alias("total_amount"),
        (k % 5 + 1).alias("items_count"),
        F.when(k % 3 == 0, F.lit(0)).otherwise(F.floor(F.col("o_totalprice") / 100)).cast("bigint").alias("loyalty_points_earned"),
        F.when(F.col("pct") >= 30, F.lit(" save10 ")).when(F.col("pct") > 0, F.lit("")).alias("promotion_code"),
        F.when(refund, F.lit("Returned ")).alias("refund_reason"),
        F.when(refund, F.lit("Refunded")).otherwise(F.lit("Completed")).alias("status"),
        ids["product_id"].alias("product_id"),
        F.concat(F.lit("Part#"), _pad(F.col("l_partkey"), 9), F.when(n % 4 == 0, F.lit(NBSP)).otherwise(F.lit(""))).alias("product_name"),
        F.concat(F.lit("Category "), (F.col("l_partkey") % 12).cast("string")).alias("category"),
        F.col("qty").alias("quantity"),
        F.col("price").alias("unit_price"),
        F.col("pct").alias("discount_percent"),
        F.when(k % 31 == 0, F.lit(0.0))
        .otherwise(money(F.col("qty") * F.col("price") * (1 - F.col("pct") / 100))).alias("line_total"),
        F.date_add(F.col("l_shipdate").cast("date"), F.when((F.col("copy") == "DUP") & (k % 2 == 0), 31).otherwise(0))
        .cast("timestamp_ntz").alias("data_created_modified"), *(also or []),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer master data."""
    k = F.col("c_custkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    df = _spread(table(spark, sf_dir, "customer"), "c_custkey").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    other_state = F.concat(F.lit("NATION_"), ((F.col("c_nationkey") + 1) % 25).cast("string"))
    df = (
        df.withColumn("city", F.when(k % 33 == 1, F.lit("")).when(k % 33 != 0, F.concat(F.lit("City"), F.col("c_nationkey").cast("string"))))
        .withColumn("state", F.when(k % 11 == 0, other_state).when(k % 45 == 2, F.lit("")).otherwise(F.col("n_name")))
        .withColumn("zip_code", _pad(F.col("c_nationkey") * 1000 + k % 37, 5))
    )
    key = k.cast("string")
    form = k % 8
    email = (
        F.when(form == 1, F.concat(F.lit("User"), key, F.lit(" at Mail.com")))
        .when(form == 2, F.concat(F.lit("user"), key, F.lit("@@mail.com")))
        .when(form == 3, F.concat(F.lit("plain"), key))
        .when(form == 4, F.concat(F.lit("  U"), key, F.lit("@X.ORG ")))
        .when(k % 16 == 5, F.lit(""))
        .when(k % 24 == 6, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("user"), key, F.lit("@mail.com")))
    )
    return df.select(
        F.concat(F.lit("CUST"), _pad(k, 9)).alias("customer_id"),
        _pick(k, "Anna", "José", "Zoë", "Omar", "Mei" + ZWSP, " Li ").alias("first_name"),
        F.when(k % 50 != 49, F.concat(F.lit("Name"), key, F.when(k % 7 == 0, F.lit(NBSP)).otherwise(F.lit("")))).alias("last_name"),
        email.alias("email"),
        _phone(k).alias("phone"),
        _address(k, F.col("city"), F.col("state"), F.col("zip_code")).alias("address"),
        "city", "state", "zip_code",
        F.when(k % 40 == 4, F.lit("")).when(k % 40 == 5, F.lit("bad")).when(k % 40 != 3, _day("1930-01-01", k * 13 % 27000)).alias("date_of_birth"),
        _pick(k, "M", "female", "Other", "x", None, " f ").alias("gender"),
        F.when(k % 52 == 7, F.lit("")).otherwise(_day("1996-01-01", k * 7 % 2300)).alias("registration_date"),
        F.when(k % 3 == 0, True).when(k % 3 == 1, False).alias("loyalty_member"),
        _pick(k, "email", "PHONE ", "sms", "fax").alias("preferred_contact"),
        F.when(k % 5 == 4, F.col("c_mktsegment")).otherwise(_pick(k, "VIP", "premium", "Regular", "BUDGET")).alias("customer_segment"),
        F.col("c_acctbal").alias("total_lifetime_value"),
        F.lit("2001-12-01").cast("date").alias("modified_date"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product master data; one product in ten is listed twice, once noisily."""
    k, size = F.col("p_partkey"), F.col("p_size")
    key = k.cast("string")
    clean = F.concat(F.col("p_name"), F.lit(" "), key)
    noisy = F.concat(clean, F.lit(ZWSP))
    names = F.when(k % 10 == 3, F.array(noisy)).when(k % 10 == 7, F.array(clean, noisy)).otherwise(F.array(clean))
    step = size % 13
    price = (
        F.when(k % 71 == 0, F.lit(None).cast("double"))
        .when(k % 103 == 1, F.lit(0.5))
        .when(k % 101 == 1, money(F.col("p_retailprice") * 20))
        .otherwise(money(F.col("p_retailprice") * step * step / 20))
    )
    df = _spread(table(spark, sf_dir, "part"), "p_partkey").withColumn("product_name", F.explode(names)).withColumn("price", price)
    rate = F.when(size % 17 == 0, F.lit(1.2)).otherwise(F.lit(0.4) + size / F.lit(100.0))
    return df.select(
        F.concat(F.lit("PRD"), _pad(k, 9)).alias("product_id"),
        "product_name",
        F.when(k % 67 != 0, F.concat(F.when(k % 12 == 0, F.lit(NBSP)).otherwise(F.lit("")), F.col("p_type"))).alias("category"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("subcategory"),
        F.concat(F.col("p_brand"), F.when(k % 9 == 0, F.lit(BAD_CHAR)).otherwise(F.lit(""))).alias("brand"),
        "price",
        F.when(k % 73 != 0, money(F.col("price") * rate)).alias("cost"),
        F.when(k % 19 == 1, F.lit("")).when(k % 19 != 0, F.concat(F.lit(" SKU-"), key)).alias("sku"),
        F.when(k % 29 == 1, F.lit(0.005)).when(k % 31 == 1, F.lit(1200.0)).when(k % 23 != 0, size / F.lit(2.0)).alias("weight"),
        F.when(k % 37 != 0, F.concat(size.cast("string"), F.lit("x"), (size + 1).cast("string"), F.lit("x2"))).alias("dimensions"),
        F.when(k % 41 != 0, k * 7 % 120 - 5).alias("stock_quantity"),
        F.when(k % 43 != 0, F.concat(F.lit("Vendor "), (k % 50).cast("string"))).alias("supplier"),
        F.when(k % 47 != 0, _day("1998-01-01", k * 11 % 1600)).alias("launch_date"),
        F.lit("2001-12-01").cast("date").alias("modified_date"),
    )


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store master data; one store in ten has no clean spelling."""
    k = F.col("s_suppkey")
    df = (
        table(spark, sf_dir, "supplier")
        .withColumn("city", F.when(k % 27 != 9, _pick(k, "New York", "Chicago", "Denver" + NBSP, "Springfield", "Austin")))
        .withColumn("state", _pick(k, "CA", "TX", "NY", "OH", "FL", "WA"))
        .withColumn("zip_code", F.concat(F.lit("9"), _pad(k % 10000, 4)))
    )
    return df.select(
        F.concat(F.lit("ST"), _pad(k, 6)).alias("store_id"),
        F.concat(F.col("s_name"), F.when(k % 10 == 3, F.lit(ZWSP)).otherwise(F.lit(""))).alias("store_name"),
        _address(k, F.col("city"), F.col("state"), F.col("zip_code")).alias("address"),
        "city", "state", "zip_code",
        _phone(k * 3).alias("phone"),
        F.when(k % 13 != 0, F.concat(F.lit("Manager "), k.cast("string"))).alias("manager"),
        _pick(k, "Online", "Flagship", "main ", "Express", "Outlet", "kiosk", "Warehouse", "pop-up").alias("store_type"),
        F.when(k % 21 != 0, _day("1975-01-01", k * 97 % 10000)).alias("opening_date"),
        F.lit("2001-12-01").cast("date").alias("modified_date"),
    )


def zip_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty ZIP codes per nation, standing in for the seed file."""
    i, nk = F.col("i"), F.col("n_nationkey")
    df = table(spark, sf_dir, "nation").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(29))))
    return df.select(
        _pad(nk * 1000 + i, 5).alias("zip_code"),
        F.concat(F.lit("N"), _pad(nk, 2)).alias("state_abrv"),
        F.col("n_name").alias("state_name"),
        F.concat(F.lit("County "), i.cast("string")).alias("county_name"),
        _pad(nk * 100 + i % 10, 5).alias("fips_code"),
        (nk + 20).cast("double").alias("cent_lat"),
        (-(i + 60)).cast("double").alias("cent_long"),
    )


def nested_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with an ``items`` array of zero to three items, as the live till sends them."""
    k = F.col("o_orderkey")

    def item(i: Column) -> Column:
        part = (k * 7 + i * 13) % 1999
        price = money(F.lit(5.0) + part / F.lit(10.0))
        qty = F.when(k % 17 == 0, -i).otherwise(i)
        return F.struct(
            F.concat(F.lit("PRD"), _pad(part, 9)).alias("product_id"),
            F.concat(F.lit("Part#"), _pad(part, 9)).alias("product_name"),
            F.when(part % 12 != 0, F.concat(F.lit("Category "), (part % 12).cast("string"))).alias("category"),
            qty.alias("quantity"),
            price.alias("unit_price"),
            F.lit(0.0).alias("discount_percent"),
            money(qty * price).alias("line_total"),
        )

    steps = F.when(k % 4 == 0, F.expr("cast(array() as array<bigint>)")).otherwise(F.sequence(F.lit(1).cast("bigint"), k % 4))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("TXN"), F.date_format("o_orderdate", "yyyyMMdd"), _pad(k, 12)).alias("transaction_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.when(k % 20 != 0, F.concat(_pad(k % 15 + 8, 2), F.lit(":"), _pad(k % 60, 2), F.lit(":00"))).alias("time"),
        F.when(k % 20 != 0, F.col("o_orderdate")).alias("datetime"),
        F.concat(F.lit("CUST"), _pad(F.col("o_custkey"), 9)).alias("customer_id"),
        F.concat(F.lit("ST"), _pad(k % 15, 6)).alias("store_id"),
        F.when(k % 9 != 0, F.concat(F.lit("EMP"), _pad(k % 500, 4))).alias("cashier_id"),
        F.when(k % 13 != 0, F.col("o_orderpriority")).alias("payment_method"),
        F.col("o_totalprice").alias("total_amount"),
        (k % 4).alias("items_count"),
        _pick(k, "Completed", "Completed", "Completed", "Failed", "Refunded").alias("status"),
        F.transform(steps, item).alias("items"),
    )


def live_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON till messages: (value, ts), the shape a topic delivers; some are sent twice."""
    e = F.col("event_id")
    message = F.to_json(
        F.struct(
            F.concat(F.when(e % 11 == 0, F.lit("DUP")).otherwise(F.lit("")), F.lit("TXN"), F.date_format("ts", "yyyyMMdd"), _pad(e, 12)).alias("transaction_id"),
            F.date_format("ts", "yyyy-MM-dd").alias("date"),
            F.when(e % 25 != 0, F.date_format("ts", "HH:mm:ss")).alias("time"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("datetime"),
            F.concat(F.lit("CUST"), _pad(F.col("user_id"), 9)).alias("customer_id"),
            F.concat(F.lit("ST-"), F.col("event_type")).alias("store_id"),
            F.when(e % 13 == 0, F.lit("nan")).otherwise(F.lit("card")).alias("payment_method"),
            F.when(e % 37 == 0, F.lit("oops")).otherwise(F.col("value").cast("decimal(18,2)").cast("string")).alias("total_amount"),
            (e % 5 + 1).cast("string").alias("items_count"),
            F.lit("Completed").alias("status"),
            F.concat(F.lit("PRD"), _pad(e % 50, 9)).alias("product_id"),
            (e % 3 + 1).cast("string").alias("quantity"),
            F.col("value").cast("decimal(18,2)").cast("string").alias("line_total"),
        )
    )
    sends = F.explode(F.when(e % 17 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    df = table(spark, sf_dir, "events").select("*", sends.alias("send"))
    return df.select(message.alias("value"), F.col("ts"))


def live_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store names for the live stream: one per event type but 'error'."""
    types = table(spark, sf_dir, "events").select("event_type").distinct().where("event_type <> 'error'")
    return types.select(
        F.concat(F.lit("ST-"), F.col("event_type")).alias("store_id"),
        F.concat(F.lit("Store "), F.initcap("event_type")).alias("store_name"),
    )
