"""DRF1: schema drift of stored tables, resolved by its kind.

Columns that a batch adds or widens need no rebuild: a schema version is put beside the table (``sinks.read_table``
applies it), stored files stay as they are, old rows read NULL in an added column and the wider type in a widened
one.  Columns that are gone or changed to a type that does not hold the stored values need the table built anew.
Every change is logged, with how it was resolved, once it is in force.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.sources import sinks

# Types whose values Spark's Parquet reader takes as those of the wider type.
_WIDER = {
    "tinyint": {"smallint", "int", "bigint", "double"}, "smallint": {"int", "bigint", "double"}, "int": {"bigint", "double"},
    "float": {"double"}, "date": {"timestamp_ntz"},
}


def widens(held: T.DataType, fresh: T.DataType) -> bool:
    """True when every value of ``held`` is one of ``fresh`` and stored files can be read as such."""
    if isinstance(held, T.DecimalType) and isinstance(fresh, T.DecimalType):
        return fresh.scale >= held.scale and fresh.precision - fresh.scale >= held.precision - held.scale and fresh != held
    return fresh.simpleString() in _WIDER.get(held.simpleString(), ())


@dataclass(frozen=True)
class Drift:
    """Names of the columns that differ, by kind; order and nullability do not matter."""

    added: tuple[str, ...] = ()
    widened: tuple[str, ...] = ()
    narrower: tuple[str, ...] = ()  # the stored type is the wider one already: rows are cast when they come in
    removed: tuple[str, ...] = ()
    incompatible: tuple[str, ...] = ()

    def __bool__(self) -> bool:
        return bool(self.added or self.widened or self.narrower or self.removed or self.incompatible)

    @property
    def method(self) -> str | None:
        """How it is resolved: None if stored rows can stay and no reader has to know."""
        if self.removed or self.incompatible:
            return "full_refresh"
        return "schema_version" if self.added or self.widened else None


def classify(held: T.StructType, fresh: T.StructType) -> Drift:
    """What differs between a stored schema and that of new rows."""
    have, want = {f.name: f.dataType for f in held}, {f.name: f.dataType for f in fresh}
    kinds: dict[str, list[str]] = {"widened": [], "narrower": [], "incompatible": []}
    for name in have:
        if name in want and have[name].simpleString() != want[name].simpleString():
            kind = "widened" if widens(have[name], want[name]) else "narrower" if widens(want[name], have[name]) else "incompatible"
            kinds[kind].append(name)
    return Drift(
        tuple(n for n in want if n not in have), tuple(kinds["widened"]), tuple(kinds["narrower"]), tuple(n for n in have if n not in want),
        tuple(kinds["incompatible"]),
    )


def merged_schema(held: T.StructType, fresh: T.StructType, drift: Drift) -> T.StructType:
    """The stored columns with wider types, then the added ones."""
    new = {f.name: f for f in fresh}
    fields = [T.StructField(f.name, new[f.name].dataType if f.name in drift.widened else f.dataType) for f in held]
    return T.StructType([*fields, *[T.StructField(n, new[n].dataType) for n in drift.added]])


def conformed(rows: DataFrame, held: T.StructType) -> DataFrame:
    """Rows with the stored type where that is the wider one."""
    wide = {n: F.col(n).cast(held[n].dataType) for n in classify(held, rows.schema).narrower}
    return rows.withColumns(wide) if wide else rows


def guard(rows: DataFrame, expected: T.StructType, name: str) -> DataFrame:
    """Raw rows in the expected types; fails if a column is missing or of a type that does not fit.

    Columns the layers do not know are left as they are, narrower ones are widened.
    """
    drift = classify(expected, rows.schema)
    wrong = [*drift.removed, *drift.incompatible, *drift.widened]
    if wrong:
        raise ValueError(f"{name}: schema out of sync: {', '.join(wrong)}")
    return conformed(rows, expected)


def log_change(spark: SparkSession, log_path: str, model: str, method: str, at: Column, run_id: str) -> None:
    """One row of the log of schema changes."""
    row = spark.range(1).select(
        F.lit(model).alias("model_name"), at.alias("detected_at"), F.lit(method).alias("reconciliation_method"),
        F.lit("completed").alias("reconciliation_status"), F.lit(run_id).alias("run_id"), at.alias("created_at"),
    )
    sinks.append_log(spark, log_path, row, "log_id")


def reconcile(
    spark: SparkSession, path: str, model: str, fresh: T.StructType, rebuild: Callable[[], None], log_path: str, at: Column, run_id: str,
    partition: str | None = None,
) -> str | None:
    """Bring the table at ``path`` in line with rows of schema ``fresh``; returns how, None if there was nothing to do.

    ``rebuild`` builds the table anew.  ``partition`` is a column that only the stored table has.
    """
    held = T.StructType([f for f in sinks.read_table(spark, path).schema if f.name != partition])
    drift = classify(held, fresh)
    if drift.method == "full_refresh":
        rebuild()
    elif drift.method == "schema_version":
        whole = merged_schema(held, fresh, drift)
        if partition:
            whole = whole.add(sinks.read_table(spark, path).schema[partition])
        sinks.set_schema(spark, path, whole)
    if drift.method:
        log_change(spark, log_path, model, drift.method, at, run_id)
    return drift.method
