"""A type-2 dimension stored as current and closed versions in parts of their own (SCD1-SCD3).

Current rows lie in buckets by a hash of the id, closed rows in a part that is only added to.  A batch is compared
with the current rows of its own buckets; it rewrites the buckets in which something changed and adds the rows it
closes, in one commit.  Closed history is neither read nor written again, and a batch without changes commits
nothing.  Rows are those of ``scd.merge`` on the whole dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.operators import scd
from tillhouse.session import discard, materialise
from tillhouse.sources import sinks
from tillhouse.sources.manifests import PartTable

CLOSED = "closed"
#: Current rows a bucket is planned for; with twice as many on average, the buckets are made anew.
BUCKET_ROWS = 500_000


def bucket(id_col: str, buckets: int) -> Column:
    """The part of an id's current version."""
    return F.concat(F.lit("current-"), F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("string"))


class Dimension:
    """The dimension stored at ``path``; ``tracked`` are the attributes whose change opens a version."""

    def __init__(
        self, spark: SparkSession, path: str, id_col: str, key_col: str, attributes: list[str], tracked: list[str], bucket_rows: int = BUCKET_ROWS,
    ):
        self.table, self.bucket_rows = PartTable(spark, path), bucket_rows
        self.id_col, self.key_col, self.attributes, self.tracked = id_col, key_col, attributes, tracked

    def _buckets(self, rows: int) -> int:
        return max(1, -(-rows // self.bucket_rows))

    def versions(self) -> DataFrame:
        """All versions."""
        return self.table.read()

    def current(self) -> DataFrame:
        """SCD3: the versions valid now; no file of closed versions is opened."""
        manifest = self.table.manifest()
        return self.table.read({p for p, _ in manifest.parts if p != CLOSED}, manifest)

    def take(self, batch: DataFrame, at: Column) -> None:
        """SCD1 for the first batch, SCD2 for later ones."""
        spark, path = self.table.spark, self.table.path
        held = sinks.finished_versions(spark, path)
        if held and not self.table.exists():  # kept as one table until now
            self._start(sinks.read_table(spark, path))
        if self.table.exists():
            for number in held:
                sinks.delete(spark, f"{path}/v{number:06d}")
            self._merge(batch, at)
        else:
            rows = materialise(scd.initial_load(batch, self.id_col, self.key_col, self.attributes, at), "dimension-load")
            self._start(rows)
            discard(rows)

    def _start(self, rows: DataFrame) -> None:
        """The first commit, of the versions given."""
        count = scd.current(rows).count()
        buckets = self._buckets(count)
        part = F.when(F.col("is_current"), bucket(self.id_col, buckets)).otherwise(CLOSED)
        self.table.commit(rows.withColumn("part", part), set(), buckets, count)

    def _merge(self, batch: DataFrame, at: Column) -> None:
        manifest = self.table.manifest()
        there = {p for p, _ in manifest.parts if p != CLOSED}
        part = bucket(self.id_col, manifest.buckets)
        batch = materialise(scd.one_per_id(batch, self.id_col).select(self.id_col, *self.attributes), "dimension-batch")
        asked = there & {r[0] for r in batch.select(part).distinct().toLocalIterator()}
        held = self.table.read(asked, manifest)
        changes = materialise(scd.new_or_changed(held, batch, self.id_col, self.tracked), "dimension-changes")
        touched = {r[0] for r in changes.select(part).distinct().toLocalIterator()}
        if touched:
            closed = materialise(scd.closed_versions(self.table.read(touched & there, manifest), changes, self.id_col, at), "dimension-closed")
            rows = manifest.rows + changes.count() - closed.count()
            buckets = manifest.buckets
            if rows > 2 * buckets * self.bucket_rows:
                buckets, touched = self._buckets(rows), there | touched
            ids = changes.select(self.id_col)
            kept = self.table.read(touched & there, manifest).join(ids, self.id_col, "left_anti")
            fresh = scd.initial_load(changes, self.id_col, self.key_col, self.attributes, at)
            columns = manifest.schema.names
            now = kept.select(*columns).unionByName(fresh.select(*columns)).withColumn("part", bucket(self.id_col, buckets))
            self.table.commit(now.unionByName(closed.select(*columns, F.lit(CLOSED).alias("part"))), touched, buckets, rows)
            discard(closed)
        discard(changes)
        discard(batch)
