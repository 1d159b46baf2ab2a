"""Change capture and schema drift (INC1-INC4, FIL7, JOI6, DRF1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.sources.sinks import append_log, overwrite_table, read_table

def hash_changes(source: DataFrame, target: DataFrame, id_col: str, hash_col: str = "_row_hash") -> DataFrame:
    """INC1/JOI6: source rows whose (id, hash) the target does not hold.

    The same hash expression must have built both columns, otherwise every row
    looks changed on every run.
    """
    return source.join(target.select(id_col, hash_col), [id_col, hash_col], "left_anti")


def source_prints(source: DataFrame, id_col: str, name: str = "_content") -> DataFrame:
    """INC1: a fingerprint of every distinct row of a source over all its columns.

    The published ``_row_hash`` covers some columns only; capture by it would
    miss changes of the others.
    """
    content = F.to_json(F.struct(*[source[c] for c in source.columns]), {"ignoreNullFields": "false"})
    return source.select(id_col, F.sha2(content, 256).alias(name)).distinct()


def high_water_mark(target: DataFrame | None, ts: str) -> dt.datetime | None:
    """FIL7: the newest load time held, None for an absent or empty target; one aggregated value reaches the driver."""
    return None if target is None else target.agg(F.max(ts).alias("m")).first()["m"]


def newer_than(source: DataFrame, ts: str, mark: dt.datetime | None, again: bool = False) -> DataFrame:
    """INC2: rows above the mark; a literal, so that file statistics can skip files.

    Without a mark everything is new.  ``again`` takes rows of the mark itself once
    more: a later file may hold rows of the same time, and an upsert repeats nothing.
    """
    if mark is None:
        return source
    at = F.lit(mark.isoformat(sep=" ")).cast("timestamp_ntz")
    return source.where(F.col(ts) >= at if again else F.col(ts) > at)


def newer_than_target(source: DataFrame, ts: str, target: DataFrame, target_ts: str) -> DataFrame:
    """INC2 without an action: the mark as a one-row join inside the plan; an empty target holds nothing back."""
    mark = target.agg(F.max(target_ts).cast("timestamp_ntz").alias("_mark"))
    return source.join(F.broadcast(mark), F.col("_mark").isNull() | (F.col(ts) > F.col("_mark"))).drop("_mark")


def new_profile_days(profile: DataFrame, held: DataFrame) -> DataFrame:
    """INC4: profile rows of days after the last one held."""
    return newer_than_target(profile, "profile_date", held, "profile_date")


def schema_drift(expected: T.StructType, actual: T.StructType) -> list[str]:
    """DRF1: readable differences between two schemas; order does not matter."""
    want = {f.name: f.dataType.simpleString() for f in expected}
    have = {f.name: f.dataType.simpleString() for f in actual}
    found = [f"missing column {n}" for n in want if n not in have]
    found += [f"new column {n}" for n in have if n not in want]
    found += [f"column {n}: {want[n]} became {have[n]}" for n in want if n in have and want[n] != have[n]]
    return found


def assert_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Fail on drift, as a table with a fixed schema must."""
    found = schema_drift(expected, df.schema)
    if found:
        raise ValueError("schema out of sync: " + "; ".join(found))
    return df


def rebuild_on_drift(spark: SparkSession, path: str, model: str, fresh: DataFrame, log_path: str, at: Column, run_id: str) -> bool:
    """DRF1: rebuild the table when its schema differs and log the rebuild."""
    if not schema_drift(read_table(spark, path).schema, fresh.schema):
        return False
    overwrite_table(fresh, path)
    row = spark.range(1).select(
        F.lit(model).alias("model_name"), at.alias("detected_at"), F.lit("full_refresh").alias("reconciliation_method"),
        F.lit("completed").alias("reconciliation_status"), F.lit(run_id).alias("run_id"), at.alias("created_at"),
    )
    append_log(spark, log_path, row, "log_id")
    return True
