"""Operators that work the same on a stream and on a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.text import DUPLICATE_MARKER
from tillhouse.sources import schemas

# Fixed value: how a missing text arrives from the till.
MISSING_TEXT = "nan"


def parse_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """STR1: JSON text to columns; other columns of the source are kept."""
    rest = [c for c in messages.columns if c != value]
    parsed = F.from_json(F.col(value).cast("string"), schemas.live_message())
    return messages.select(*rest, parsed.alias("m")).select(*rest, "m.*")


def coerce_types(df: DataFrame) -> DataFrame:
    """CLN24/STR2: typed columns; what does not parse becomes NULL."""
    typed = {n: F.col(n).try_cast("date") for n in schemas.LIVE_DATES}
    typed |= {n: F.col(n).try_cast("timestamp_ntz") for n in schemas.LIVE_TIMESTAMPS}
    typed |= {n: F.col(n).try_cast(kind) for n, kind in schemas.LIVE_NUMBERS.items()}
    typed |= {n: F.nullif(F.col(n), F.lit(MISSING_TEXT)) for n in schemas.LIVE_STRINGS}
    return df.withColumns({n: e for n, e in typed.items() if n in df.columns})


def drop_marked_duplicates(df: DataFrame) -> DataFrame:
    """FIL8: copies the till marked itself; an unknown id is not a marked copy."""
    return df.where(~F.coalesce(F.col("transaction_id").contains(DUPLICATE_MARKER), F.lit(False)))


def enrich_with_stores(df: DataFrame, stores: DataFrame) -> DataFrame:
    """JOI10/STR6: store names from master data; unknown stores stay."""
    return df.drop("store_name").join(stores.select("store_id", "store_name"), "store_id", "left")


def flatten_items(nested: DataFrame) -> DataFrame:
    """SRC8: one row per item; a transaction without items keeps one row with zeros."""
    rows = nested.withColumn("item", F.explode_outer("items")).drop("items")
    zero = {"quantity": F.lit(0).cast("bigint"), "unit_price": F.lit(0.0), "discount_percent": F.lit(0.0), "line_total": F.lit(0.0)}
    fields = [f.name for f in rows.schema["item"].dataType.fields]
    # Only an absent item gets zeros; a NULL inside an item stays NULL.
    values = [
        F.when(F.col("item").isNull(), zero[f]).otherwise(F.col(f"item.{f}")).alias(f) if f in zero else F.col(f"item.{f}").alias(f)
        for f in fields
    ]
    return rows.select(*[c for c in rows.columns if c != "item"], *values)
