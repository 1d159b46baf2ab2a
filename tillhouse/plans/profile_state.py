"""Profiles brought forward by what a batch changed (INC4 over AGG1 and AGG3).

Two things are stored beside a line table: its figures by day, and how often each customer, product, store, payment
method and date stands on each day.  A batch puts lines in and replaces others; both come from the upsert.

* Figures over lines: those of the lines put in are added, those of the lines replaced taken off.
* Distinct values: reference counts of the days touched are brought forward and counted; no other day is read.
* Figures over transactions (distinct transactions and pairs, repeated lines, header money on the day of the first
  line) can change on other days too.  All lines of the batch's transactions are read from the partitions that the
  table's key filters name; what these transactions count now is added, what they counted before taken off.

All sums are exact, so the result equals the profile of the whole table.  While the table is being changed a marker lies
beside the state; a run that finds one left behind counts the table anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.plans.profiles import Layer
from tillhouse.session import discard, materialise
from tillhouse.sources import sinks

REFERENCES = "kind string, value string, n long, of_day date"


class ProfileState:
    """The state of ``layer`` for the line table at ``table``, which is partitioned by ``partition``."""

    def __init__(self, spark: SparkSession, path: str, layer: Layer, table: str, partition: str = "part"):
        self.spark, self.layer, self.table, self.partition = spark, layer, table, partition
        self.days, self.refs, self.marker = f"{path}/days", f"{path}/references", f"{path}/_changing"
        self.stale = False

    def begin(self) -> None:
        """Before the table changes."""
        self.stale = sinks.exists(self.spark, self.marker) or not sinks.table_exists(self.spark, self.days)
        sinks.touch(self.spark, self.marker)

    def apply(self, added: DataFrame, replaced: DataFrame) -> None:
        """After the table has changed: ``added`` lines stand in it, ``replaced`` ones no longer do."""
        if self.stale:
            self.rebuild(self.spark.read.schema(added.schema).parquet(self.table))
        else:
            self._bring_forward(added, replaced)
        sinks.delete(self.spark, self.marker)

    def rebuild(self, table: DataFrame) -> None:
        """Count the whole table."""
        rows = self.layer.weighted(table)
        references = materialise(self._by_day(self.layer.references(rows)), "references")
        sinks.delete(self.spark, self.refs)
        sinks.gathered(references, "of_day").write.partitionBy("of_day").parquet(self.refs)
        distinct = self.layer.distinct_figures(self._by_date(references))
        sinks.overwrite_table(self.layer.together([self.layer.sums(rows), distinct, *self.layer.per_transaction(rows)]), self.days)
        discard(references)

    @staticmethod
    def _by_day(references: DataFrame) -> DataFrame:
        return references.select("kind", "value", "n", F.col("profile_date").cast("date").alias("of_day"))

    @staticmethod
    def _by_date(references: DataFrame) -> DataFrame:
        return references.select(F.col("of_day").cast("timestamp_ntz").alias("profile_date"), "kind", "value", "n")

    def _bring_forward(self, added: DataFrame, replaced: DataFrame) -> None:
        layer = self.layer
        changes = layer.weighted(added).unionByName(layer.weighted(replaced, -1))
        touched = [r[0] for r in changes.select(F.col("profile_date").cast("date")).distinct().toLocalIterator()]  # days
        on_touched = F.col("of_day").isin(touched)
        held = self.spark.read.schema(REFERENCES).parquet(self.refs).where(on_touched)
        references = held.unionByName(self._by_day(layer.references(changes))).groupBy("kind", "value", "of_day").agg(F.sum("n").alias("n"))
        references = materialise(references.where("n > 0").select("kind", "value", "n", "of_day"), "references")

        transactions = changes.select(layer.transaction).distinct()
        now = layer.weighted(sinks.rows_with_keys(self.spark, self.table, transactions, [layer.transaction], self.partition, added.schema))
        now = materialise(now.groupBy("profile_date", *layer.line).agg(F.sum("w").alias("w")), "profile-lines")
        undone = changes.select("profile_date", *layer.line, (-F.col("w")).alias("w"))
        before = now.unionByName(undone).groupBy("profile_date", *layer.line).agg(F.sum("w").alias("w")).where("w > 0")

        days = sinks.read_table(self.spark, self.days)
        replaced_figures = [c for c in days.columns if c in layer.distinct or c in (f"min_{layer.dated}", f"max_{layer.dated}")]
        kept = days.select(*[
            F.when(F.col("profile_date").cast("date").isin(touched), F.lit(None)).otherwise(F.col(c)).alias(c) if c in replaced_figures else F.col(c)
            for c in days.columns
        ])
        parts = [kept, layer.sums(changes), layer.distinct_figures(self._by_date(references)), *layer.per_transaction(now)]
        parts += [p.select("profile_date", *[(-F.col(c)).cast(p.schema[c].dataType).alias(c) for c in p.columns if c != "profile_date"]) for p in layer.per_transaction(before)]
        figures = materialise(layer.together(parts).where("total_line_items > 0"), "profile-days")

        writer = sinks.gathered(references, "of_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("of_day").parquet(self.refs)
        left = {r[0] for r in references.select("of_day").distinct().toLocalIterator()}
        for day in set(touched) - left:
            sinks.delete(self.spark, f"{self.refs}/of_day={day}")
        sinks.overwrite_table(figures, self.days)
        for scratch in (references, now, figures):
            discard(scratch)

    def profile(self) -> DataFrame:
        """AGG1 or AGG3 of the table, from the stored figures."""
        return self.layer.finish(sinks.read_table(self.spark, self.days))
