"""SNK3/STR3: the small files of closed days packed into few large ones.

The stream appends one file per task, day and trigger (``live.write_daily_files``).  ``DailyFiles.pack`` reads the
files of closed days that are not packed yet and adds them, binned by REBALANCE into files of AQE's advisory size, to
a table of parts (``sources/manifests``), one part per day.  ``consumed/vN`` names all files whose lines manifest N
holds and is written before it; the manifest is the commit.  So a reader takes the packs of the newest manifest and
those files of the stream's own log that its list does not name: each line once, also after a crash at any point.

Late lines make new files, which the next run packs: they are added to their day, and a day of more than ``PACKS``
packs is written anew as one, so a late line costs no rewrite of its day and the packs of a day stay few.  Files
are deleted once two manifests in a row hold their lines, since a reader may still be at the manifest before.  From
then on the folder is read by ``DailyFiles.read`` only; the stream itself never reads what it wrote.
The list of consumed files is as long as the stream's own log of files, which Spark keeps on the driver as well.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillhouse.sources import sinks
from tillhouse.sources.manifests import PartTable

DAY = "file_day"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
PACKS = 4


class DailyFiles:
    """Lines streamed into ``path``, packed into ``packed``; ``schema`` is that of the lines."""

    def __init__(self, spark: SparkSession, path: str, packed: str, schema: StructType):
        self.spark, self.path, self.table, self.packed = spark, path.rstrip("/"), PartTable(spark, packed), packed
        self.schema = StructType([f for f in schema.fields if f.name != DAY]).add(DAY, "date")

    def _written(self) -> dict[str, str]:
        """Files the stream has committed: name under its folder -> path."""
        if not sinks.exists(self.spark, f"{self.path}/_spark_metadata"):
            return {}
        files = self.spark.read.schema(self.schema).parquet(self.path).inputFiles()
        return {"/".join(f.split("/")[-2:]): f for f in files}

    def _consumed(self, number: int | None) -> set[str]:
        """Names of the files whose lines a manifest holds."""
        if number is None:
            return set()
        return {r["file"] for r in self.spark.read.schema("file string").parquet(f"{self.packed}/consumed/v{number:06d}").collect()}

    def _rows(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*files)

    def loose(self) -> dict[str, str]:
        """Files not packed yet."""
        manifest = self.table.manifest() if self.table.exists() else None
        gone = self._consumed(manifest.number if manifest else None)
        return {n: f for n, f in self._written().items() if n not in gone}

    def read(self) -> DataFrame:
        """All lines, each once."""
        if not self.table.exists():
            return self._rows(sorted(self._written().values()))
        manifest = self.table.manifest()
        gone = self._consumed(manifest.number)
        loose = [f for n, f in sorted(self._written().items()) if n not in gone]
        return self.table.read(manifest=manifest).unionByName(self._rows(loose))

    def pack(self, open_from: dt.date | None = None) -> int:
        """Pack the files of days before ``open_from`` (default: the newest day there is); returns how many.

        Lines without a day are packed whenever there are any.
        """
        before = self.table.manifest() if self.table.exists() else None
        consumed = self._consumed(before.number if before else None)
        written = self._written()
        days = {n: n.partition("/")[0].partition("=")[2] for n in written}
        newest = open_from.isoformat() if open_from else max((d for d in days.values() if d != NO_DAY), default="")
        chosen = sorted(n for n in written if n not in consumed and (days[n] == NO_DAY or days[n] < newest))
        if not chosen:
            return 0
        packs: dict[str, int] = {}
        for part, _ in before.parts if before else ():
            packs[part] = packs.get(part, 0) + 1
        full = {part for part in {days[n] for n in chosen} if packs.get(part, 0) >= PACKS}
        rows = self._rows([written[n] for n in chosen])
        if full:
            rows = rows.unionByName(self.table.read(full, before))
        number = before.number + 1 if before else 1
        names = self.spark.createDataFrame([(n,) for n in sorted(consumed | set(chosen))], "file string")
        names.coalesce(1).write.mode("overwrite").parquet(f"{self.packed}/consumed/v{number:06d}")
        part = F.coalesce(F.col(DAY).cast("string"), F.lit(NO_DAY))
        self.table.commit(rows.withColumn("part", part), full, 0, 0)
        self._clean(consumed, number)
        return len(chosen)

    def _clean(self, consumed: set[str], newest: int) -> None:
        """Delete the lists of manifests before the last two, and files that both of those hold."""
        for n in sinks.finished_versions(self.spark, f"{self.packed}/consumed"):
            if n < newest - 1:
                sinks.delete(self.spark, f"{self.packed}/consumed/v{n:06d}")
        folder, fs = sinks.folder_of(self.spark, self.path)
        files = fs.listFiles(folder, True)
        while files.hasNext():
            file = files.next().getPath()
            if f"{file.getParent().getName()}/{file.getName()}" in consumed:
                fs.delete(file, False)
