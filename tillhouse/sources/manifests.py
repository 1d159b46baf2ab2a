"""Tables kept as parts that are never rewritten, and manifests that name the parts in force.

``parts/version=N/part=P`` holds what commit N wrote of part P, ``manifest/vN`` the list of the (part, version)
pairs that make up the table after it.  A manifest is written last and counts once Spark has put its ``_SUCCESS``
marker.  So a commit writes only the parts it changes, all others are shared by many versions of the table, and
readers see a commit whole or not at all.  What a run cut short has left under its number is overwritten by the
next one.  The manifest before the newest stays readable; parts that neither names are deleted.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillhouse.sources import sinks

ROWS = "part string, version long, schema string, buckets int, rows long"


@dataclass(frozen=True)
class Manifest:
    """What a table consists of.  ``buckets`` and ``rows`` are kept for the owner of the table."""

    number: int
    schema: StructType
    parts: frozenset[tuple[str, int]]
    buckets: int
    rows: int


class PartTable:
    """A table of parts under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _numbers(self) -> list[int]:
        return sinks.finished_versions(self.spark, f"{self.path}/manifest")

    def exists(self) -> bool:
        return bool(self._numbers())

    def manifest(self, number: int | None = None) -> Manifest:
        """The newest manifest, or an earlier one; as many rows as the table has parts."""
        number = self._numbers()[-1] if number is None else number
        rows = self.spark.read.schema(ROWS).parquet(f"{self.path}/manifest/v{number:06d}").collect()
        head = next(r for r in rows if r["part"] is None)
        schema = StructType.fromJson(json.loads(head["schema"]))
        return Manifest(number, schema, frozenset((r["part"], r["version"]) for r in rows if r["part"] is not None), head["buckets"], head["rows"])

    def read(self, parts: set[str] | None = None, manifest: Manifest | None = None, with_part: bool = False) -> DataFrame:
        """Rows of the table, or of some parts; no file of another part is opened."""
        manifest = manifest or self.manifest()
        folders = sorted(f"{self.path}/parts/version={v}/part={p}" for p, v in manifest.parts if parts is None or p in parts)
        kept = [f.name for f in manifest.schema.fields] + (["part"] if with_part else [])
        full = StructType([*manifest.schema.fields]).add("version", "long").add("part", "string")
        if not folders:
            return self.spark.createDataFrame([], full).select(*kept)
        return self.spark.read.schema(full).option("basePath", f"{self.path}/parts").parquet(*folders).select(*kept)

    def commit(self, rows: DataFrame, replaced: set[str], buckets: int, count: int) -> None:
        """Add ``rows`` (with their ``part``) to the table, in place of the parts named in ``replaced``."""
        before = self.manifest() if self.exists() else None
        number = before.number + 1 if before else 1
        folder = f"{self.path}/parts/version={number}"
        sinks.gathered(rows, "part").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("part").parquet(folder)
        written = {(name[len("part="):], number) for name in sinks.subfolders(self.spark, folder) if name.startswith("part=")}
        parts = {(p, v) for p, v in (before.parts if before else ()) if p not in replaced} | written
        self._publish(number, rows.drop("part").schema, parts, buckets, count)
        self._clean(parts | set(before.parts if before else ()), number)

    def _publish(self, number: int, schema: StructType, parts: set[tuple[str, int]], buckets: int, count: int) -> None:
        rows = [(None, None, schema.json(), buckets, count), *[(p, v, None, None, None) for p, v in sorted(parts)]]
        self.spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/v{number:06d}")

    def _clean(self, named: set[tuple[str, int]], newest: int) -> None:
        """Delete manifests before the last two, and parts that neither of those names."""
        for n in self._numbers():
            if n < newest - 1:
                sinks.delete(self.spark, f"{self.path}/manifest/v{n:06d}")
        for version in sinks.subfolders(self.spark, f"{self.path}/parts"):
            n = int(version[len("version="):])
            there = [p for p in sinks.subfolders(self.spark, f"{self.path}/parts/{version}") if p.startswith("part=")]
            idle = [p for p in there if (p[len("part="):], n) not in named]
            for name in idle:
                sinks.delete(self.spark, f"{self.path}/parts/{version}/{name}")
            if len(idle) == len(there):
                sinks.delete(self.spark, f"{self.path}/parts/{version}")


def listed(spark: SparkSession, path: str) -> str:
    """A print of the files under ``path``; Spark never writes two files of one name, so it tells whether content changed."""
    folder, fs = sinks.folder_of(spark, path)
    files, found = fs.listFiles(folder, True), []
    while files.hasNext():
        status = files.next()
        name = status.getPath().getName()
        if name[:1] not in ("_", "."):
            found.append(f"{name}:{status.getLen()}")
    return ",".join(sorted(found))


class Snapshot:
    """SNK6: tables published together by one manifest that names a copy of each of their pieces.

    A piece is a partition of an upserted table, a part of a part table, or a version of a rebuilt one.  Publishing
    copies the pieces whose files differ from those published before; the others are named again.  Readers see all
    tables of a snapshot or none.  The snapshot before the newest stays readable.
    """

    COLUMNS = "name string, piece string, print string, copy long, schema string"

    def __init__(self, spark: SparkSession, area: str):
        self.spark, self.area = spark, area

    def _numbers(self) -> list[int]:
        return sinks.finished_versions(self.spark, f"{self.area}/_snapshots")

    def _rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.area}/_snapshots/v{self._numbers()[-1]:06d}")

    def record(self) -> DataFrame:
        """``last_sync_time, status`` of the newest snapshot."""
        return self._rows().where("piece is null").select("last_sync_time", "status").distinct()

    def pieces(self, path: str) -> tuple[str, dict[str, str], DataFrame]:
        """A stored table's base folder, its pieces with their prints, and its rows with the columns that name pieces."""
        table = PartTable(self.spark, path)
        if table.exists():
            manifest = table.manifest()
            base = f"{path}/parts"
            names = [f"version={v}/part={p}" for p, v in manifest.parts]
            return base, {n: n for n in names}, table.read(manifest=manifest)
        base = sinks.current_path(self.spark, path)
        if base is None:
            raise FileNotFoundError(path)
        names = [n for n in sinks.subfolders(self.spark, base) if "=" in n and n[:1] not in ("_", ".")]
        return base, {n: listed(self.spark, f"{base}/{n}") for n in names} or {"": listed(self.spark, base)}, self.spark.read.parquet(base)

    def publish(self, tables: dict[str, DataFrame | str], at) -> DataFrame:
        """Publish tables: a path names a stored table, of which changed pieces are copied; a DataFrame is written whole."""
        spark, numbers = self.spark, self._numbers()
        number = numbers[-1] + 1 if numbers else 1
        before = {(r["name"], r["piece"]): r for r in self._rows().where("piece is not null").select("name", "piece", "print", "copy").collect()} if numbers else {}
        rows = []
        for name, source in tables.items():
            folder = f"{self.area}/{name}/snapshot_copy={number}"
            if isinstance(source, DataFrame):
                source.write.mode("overwrite").parquet(folder)
                rows += [(name, "", f"copy {number}", number, None), (name, None, None, None, source.schema.json())]
                continue
            base, prints, table = self.pieces(source)
            same = {p for p, mark in prints.items() if (name, p) in before and before[name, p]["print"] == mark}
            changed = sorted(set(prints) - same)
            if changed:
                by = [level.partition("=")[0] for level in changed[0].split("/") if level]
                full = StructType([f for f in table.schema.fields if f.name not in by])
                for column in by:
                    full = full.add(column, "string")
                reader = spark.read.schema(full).option("basePath", base)
                copied = reader.parquet(*[f"{base}/{p}" if p else base for p in changed])
                if by:
                    sinks.gathered(copied, by[-1]).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(folder)
                else:
                    copied.write.mode("overwrite").parquet(folder)
            rows += [(name, p, mark, before[name, p]["copy"] if p in same else number, None) for p, mark in prints.items()]
            rows.append((name, None, None, None, table.schema.json()))
        manifest = spark.createDataFrame(rows, self.COLUMNS).coalesce(1).withColumns({"last_sync_time": at, "status": F.lit("success")})
        manifest.write.mode("overwrite").parquet(f"{self.area}/_snapshots/v{number:06d}")
        named = {(n, p, r["copy"]) for (n, p), r in before.items()} | {(r[0], r[1], r[3]) for r in rows if r[1] is not None}
        self._clean(named, number)
        return self.record()

    def _clean(self, named: set[tuple[str, str, int]], newest: int) -> None:
        """Delete snapshots before the last two, and copies of which neither names a piece."""
        for n in self._numbers():
            if n < newest - 1:
                sinks.delete(self.spark, f"{self.area}/_snapshots/v{n:06d}")
        in_use = {(name, copy) for name, _, copy in named}
        for name in sinks.subfolders(self.spark, self.area):
            if name.startswith("_"):
                continue
            for copy in sinks.subfolders(self.spark, f"{self.area}/{name}"):
                if copy.startswith("snapshot_copy=") and (name, int(copy[len("snapshot_copy="):])) not in in_use:
                    sinks.delete(self.spark, f"{self.area}/{name}/{copy}")

    def read(self, name: str) -> DataFrame:
        """A table of the newest snapshot."""
        rows = self._rows().where(F.col("name") == name).collect()
        schema = StructType.fromJson(json.loads(next(r["schema"] for r in rows if r["piece"] is None)))
        pieces = [r for r in rows if r["piece"] is not None]
        if not pieces:
            return self.spark.createDataFrame([], schema)
        base = f"{self.area}/{name}"
        by = [level.partition("=")[0] for level in pieces[0]["piece"].split("/") if level]
        full = StructType(list(schema.fields)).add("snapshot_copy", "long")
        for column in by:
            if column not in schema.names:
                full = full.add(column, "string")
        folders = sorted(f"{base}/snapshot_copy={r['copy']}" + (f"/{r['piece']}" if r["piece"] else "") for r in pieces)
        return self.spark.read.schema(full).option("basePath", base).parquet(*folders).select(*schema.names)
