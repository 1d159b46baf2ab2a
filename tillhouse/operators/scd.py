"""Slowly changing dimensions, type 2 (SCD1-SCD3, JOI8-JOI9, FIL6)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.flags import surrogate_key
from tillhouse.operators.dedup import first_by

HISTORY = ["valid_start_date", "valid_end_date", "is_current", "created_at", "updated_at"]
NO_END = "cast(null as timestamp_ntz)"


def one_per_id(batch: DataFrame, id_col: str) -> DataFrame:
    """A batch may repeat an id; the dimension keeps one current row per id.

    The row hash of staging covers the row's content, so ordering by it gives
    the same pick every time without sorting by every column.
    """
    order = ["_row_hash"] if "_row_hash" in batch.columns else [c for c in batch.columns if c != id_col]
    return first_by(batch, [id_col], [F.col(c).asc_nulls_last() for c in order])


def initial_load(batch: DataFrame, id_col: str, key_col: str, attributes: list[str], at: Column) -> DataFrame:
    """SCD1: every row is the current version from now on."""
    return one_per_id(batch, id_col).select(
        surrogate_key(F.col(id_col), at).alias(key_col), id_col, *attributes,
        at.alias("valid_start_date"), F.expr(NO_END).alias("valid_end_date"), F.lit(True).alias("is_current"),
        at.alias("created_at"), at.alias("updated_at"),
    )


def current(dim: DataFrame) -> DataFrame:
    """SCD3: the versions valid now."""
    return dim.where("is_current")


def changed(tracked: list[str], old: str, new: str) -> Column:
    """FIL6: any tracked attribute differs, NULLs compared as values."""
    tests = [~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}")) for c in tracked]
    return reduce(lambda a, b: a | b, tests)


def new_or_changed(dim: DataFrame, batch: DataFrame, id_col: str, tracked: list[str]) -> DataFrame:
    """JOI8: batch rows without a current version, or with a different one."""
    b, d = batch.alias("b"), current(dim).select(id_col, *tracked).alias("d")
    joined = b.join(d, F.col(f"b.{id_col}") == F.col(f"d.{id_col}"), "left")
    return joined.where(F.col(f"d.{id_col}").isNull() | changed(tracked, "d", "b")).select("b.*")


def closed_versions(dim: DataFrame, changes: DataFrame, id_col: str, at: Column) -> DataFrame:
    """JOI9: current versions that a change ends."""
    ended = current(dim).join(changes.select(id_col).distinct(), id_col, "left_semi")
    return ended.withColumn("valid_end_date", at).withColumn("is_current", F.lit(False)).withColumn("updated_at", at)


def merge(dim: DataFrame, batch: DataFrame, id_col: str, key_col: str, attributes: list[str], tracked: list[str], at: Column) -> DataFrame:
    """SCD2: the whole dimension after the batch.

    One full outer join of the current versions with the batch decides, row by
    row, what comes out: the untouched version, the closed one, the new one, or
    the last two.  History passes through without a shuffle.
    """
    columns = [key_col, id_col, *attributes, *HISTORY]
    old = current(dim).select(F.col(id_col), F.struct(*columns).alias("old"))
    new = one_per_id(batch, id_col).select(
        F.col(id_col), F.struct(id_col, *attributes).alias("new")
    )
    both = old.join(new, id_col, "full_outer")

    is_change = F.col("old").isNull() | (F.col("new").isNotNull() & changed(tracked, "old", "new"))
    closed = F.struct(*[
        {"valid_end_date": at, "is_current": F.lit(False), "updated_at": at}.get(c, F.col(f"old.{c}")).alias(c) for c in columns
    ])
    fresh = F.struct(
        surrogate_key(F.col(f"new.{id_col}"), at).alias(key_col), F.col(f"new.{id_col}").alias(id_col),
        *[F.col(f"new.{c}").alias(c) for c in attributes],
        at.alias("valid_start_date"), F.expr(NO_END).alias("valid_end_date"), F.lit(True).alias("is_current"),
        at.alias("created_at"), at.alias("updated_at"),
    )
    result = (
        F.when(~is_change, F.array("old"))
        .when(F.col("old").isNull(), F.array(fresh))
        .otherwise(F.array(closed, fresh))
    )
    merged = both.select(F.explode(result).alias("v")).select("v.*")
    return dim.where("not is_current").select(*columns).unionByName(merged)
