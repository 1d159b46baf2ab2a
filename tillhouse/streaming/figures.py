"""Live figures as a log of changes, merged when they are read (STR5).

A trigger writes the figures it changed, under its epoch, and reads nothing of what is stored; an epoch that is repeated
after a restart replaces itself.  Every ``fold_every`` epochs the log is folded: the last figures of each window and store
are upserted into the base, by partitions of their day, and the folded epochs deleted.  Base and log both carry the epoch,
and a reader takes the row with the highest, so figures are right at every moment of a fold, and after one cut short.

A store belongs to one checkpoint, whose epochs rise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions.dates import utc_clock
from tillhouse.sources.sinks import current_path, delete, incremental_upsert, subfolders

KEYS = ["window_start", "store_name"]
FOLD_EVERY = 60


class FigureStore:
    """Figures by window and store under ``path``."""

    def __init__(self, spark: SparkSession, path: str, fold_every: int = FOLD_EVERY):
        self.spark, self.base, self.log, self.fold_every = spark, f"{path}/base", f"{path}/log", fold_every

    def epochs(self) -> list[int]:
        """Epochs in the log whose write has committed, ascending."""
        return sorted(int(n.split("=")[1]) for n in subfolders(self.spark, self.log, finished=True) if n.startswith("epoch="))

    def append(self, figures: DataFrame, epoch: int) -> None:
        """What an epoch changed."""
        rows = figures.withColumn("day", F.to_date(utc_clock(F.col("window_start")))).withColumn("of_epoch", F.lit(epoch).cast("long"))
        rows.write.mode("overwrite").parquet(f"{self.log}/epoch={epoch}")
        if len(self.epochs()) >= self.fold_every:
            self.fold()

    def _logged(self, epochs: list[int]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.log}/epoch={e}" for e in epochs])

    def fold(self) -> None:
        """Bring the log into the base; days without a logged figure are not read."""
        epochs = self.epochs()
        if epochs:
            incremental_upsert(self.spark, self.base, newest(self._logged(epochs)), KEYS, "day")
            for epoch in epochs:
                delete(self.spark, f"{self.log}/epoch={epoch}")

    def current(self) -> DataFrame:
        """The figures as of the last epoch."""
        epochs, parts = self.epochs(), []
        if epochs:
            parts.append(self._logged(epochs))
        if current_path(self.spark, self.base):
            parts.append(self.spark.read.schema(parts[0].schema).parquet(self.base) if parts else self.spark.read.parquet(self.base))
        if not parts:
            raise ValueError(f"no figures at {self.log}")
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return newest(rows).drop("day", "of_epoch")


def newest(rows: DataFrame) -> DataFrame:
    """The row of the highest epoch of each window and store, by partial aggregation."""
    columns = [c for c in rows.columns if c not in KEYS]
    last = F.max_by(F.struct(*columns), "of_epoch").alias("last")
    return rows.groupBy(*KEYS).agg(last).select(*KEYS, *[F.col(f"last.{c}").alias(c) for c in columns])
