"""De-duplication and per-group picks (WIN1-WIN3, SET2).

``row_number() == 1`` plans a WindowGroupLimit below the shuffle: each map task
sends at most one row per key, so a key holding a third of all rows still
reaches its reducer as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillhouse.functions.text import DUPLICATE_MARKER

# Rows of one product are dealt to this many places; its row of the lookup goes to each.
SALTS = 4
DEALT = ["_product", "_salt"]
DEALT_TRANSACTION = ["_transaction"]
LINE_VALUES = ["quantity", "unit_price", "line_total", "total_amount", "customer_id", "store_id"]


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key under ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dealt_by_product(lines: DataFrame, transaction: Column, product: Column) -> DataFrame:
    """Lines dealt out once for :func:`latest_line` and the lookup of their products, as ``_product`` and ``_salt``.

    The salt follows from the transaction, so all rows of a (transaction, product) share it, while the lines of a hot
    product go to ``SALTS`` places.  Lines without one of the ids, of which there may be many, are not dealt out.
    """
    salt = F.pmod(F.xxhash64(transaction), F.lit(SALTS)).cast("int")
    known = lines.where(transaction.isNotNull() & product.isNotNull())
    return known.withColumns({"_product": product, "_salt": salt}).repartition(*DEALT)


def dealt_by_transaction(lines: DataFrame, transaction: Column, product: Column) -> DataFrame:
    """The same for figures of transactions, as ``_transaction``: a place holds all lines of a basket."""
    known = lines.where(transaction.isNotNull() & product.isNotNull())
    return known.withColumn("_transaction", transaction).repartition(*DEALT_TRANSACTION)


def latest_line(staged: DataFrame, dealt: list[str] | None = None) -> DataFrame:
    """WIN1: one row per (transaction, product).

    Newest load first, sales before refunds, then the plain id before its
    'DUP' copy; the values of the line make the order total, without hashing
    rows that mostly have no rival.  ``dealt`` names columns that follow from the
    key and by which the rows have been dealt out already.
    """
    marked = F.col("transaction_id_raw").contains(DUPLICATE_MARKER)
    order = [
        F.col("staging_processed_at").desc(),
        F.col("is_refund").asc(),
        marked.asc(),
        F.col("raw_loaded_at").desc(),
        *[F.col(v).asc_nulls_last() for v in LINE_VALUES],
    ]
    return first_by(staged, ["transaction_id_clean", "product_id", *(dealt or [])], order)


def first_line_per_transaction(df: DataFrame, txn: str, order: list[Column]) -> DataFrame:
    """WIN2: the line that carries the header money of its transaction."""
    return first_by(df, [txn], order)


def occurrences(df: DataFrame, keys: list[str]) -> DataFrame:
    """WIN3: every row with the number of rows sharing its key.

    A window would pull a hot key into one task.  Counting is combined on the
    map side, and the join back is one AQE can split when a key is skewed.
    NULL keys count as equal, as they do in a window.
    """
    counts = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count("*").alias("occurrences"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(counts, on).drop(*[f"_{k}" for k in keys])
