"""Table writers (SNK1-SNK5, SNK7; SNK6 is in ``manifests``).

A rebuilt table is a folder of versions.  A version counts once Spark has put its
``_SUCCESS`` marker, the last step of a write; readers take the newest such one
(``read_table``).  So a write that fails midway leaves the table as it was, a plan
may read the table it rebuilds, and nothing is overwritten in place.  The version
before stays for readers that are still at it; older ones are deleted.

An upserted table is kept by partition, without versions: touched partitions are
written whole to the shared folder first, then put in place, and a run that dies in
between is repeated with the same outcome.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillhouse.session import discard, materialise
from tillhouse.sources import keyfilters


def gathered(df: DataFrame, partition: str) -> DataFrame:
    """Rows of one partition together, so that it is written as few large files.

    REBALANCE lets AQE merge small partitions and split one that holds much of
    the data; a plain repartition would give that one to a single task.
    """
    return df.hint("rebalance", F.col(partition))


def folder_of(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, path: str, finished: bool = False) -> list[str]:
    """Names of the folders under ``path``; ``finished``: only those a write has committed."""
    folder, fs = folder_of(spark, path)
    if not fs.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in fs.listStatus(folder) if entry.isDirectory()]
    return [n for n in names if not finished or fs.exists(folder_of(spark, f"{path}/{n}/_SUCCESS")[0])]


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there."""
    folder, fs = folder_of(spark, path)
    fs.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    """True when there is a file or folder."""
    folder, fs = folder_of(spark, path)
    return fs.exists(folder)


def touch(spark: SparkSession, path: str) -> None:
    """Leave an empty file."""
    file, fs = folder_of(spark, path)
    fs.create(file, True).close()


def finished_versions(spark: SparkSession, path: str) -> list[int]:
    """The finished versions of a table, ascending."""
    return sorted(int(n[1:]) for n in subfolders(spark, path, finished=True) if re.fullmatch(r"v\d+", n))


def current_path(spark: SparkSession, path: str) -> str | None:
    """Where the table's content is now; None only if there is none (other errors are raised)."""
    versions = finished_versions(spark, path)
    if versions:
        return f"{path}/v{versions[-1]:06d}"
    folder, fs = folder_of(spark, path)
    if not fs.exists(folder):
        return None
    names = [entry.getPath().getName() for entry in fs.listStatus(folder)]
    return path if any(n[:1] not in ("_", ".") and not re.fullmatch(r"v\d+", n) for n in names) else None


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when a table has content at ``path``."""
    return current_path(spark, path) is not None


SCHEMAS = "_schemas"


def set_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """Have readers take the table's present content with ``schema``: columns added since, and types widened since."""
    numbers = finished_versions(spark, f"{path}/{SCHEMAS}")
    row = [(schema.json(), (finished_versions(spark, path) or [0])[-1])]
    df = spark.createDataFrame(row, "schema string, version long").coalesce(1)
    df.write.mode("overwrite").parquet(f"{path}/{SCHEMAS}/v{(numbers[-1] if numbers else 0) + 1:06d}")


def declared_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema put beside the table, if it was for its present version."""
    numbers = finished_versions(spark, f"{path}/{SCHEMAS}")
    if not numbers:
        return None
    row = spark.read.parquet(f"{path}/{SCHEMAS}/v{numbers[-1]:06d}").first()
    return StructType.fromJson(json.loads(row["schema"])) if row["version"] == (finished_versions(spark, path) or [0])[-1] else None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished version of a table, or a table without versions, with the schema set for it, if any."""
    schema = declared_schema(spark, path)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(current_path(spark, path) or path)


def without_keys(df: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``batch`` (NULL parts compare as equal)."""
    other = batch.select(*[F.col(k).alias(f"_{k}") for k in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(other, on, "left_anti")


def upserted(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """SNK1/INC3 as a plain DataFrame: matching keys replaced, the rest appended."""
    return without_keys(target, batch, keys).unionByName(batch)


def _names(spark: SparkSession, path: str, partition: str) -> set[str]:
    """The partition folders there are."""
    return {n for n in subfolders(spark, path) if n.startswith(f"{partition}=")}


def _in_partitions(df: DataFrame, partition: str, values: list) -> DataFrame:
    """Rows of the partitions named: Spark opens no file of the others."""
    some = F.col(partition).isin([v for v in values if v is not None])
    return df.where(some | F.col(partition).isNull() if None in values else some)


def _values(df: DataFrame, partition: str) -> list:
    """Partition values, once each: as many as the table has partitions, at most."""
    return [r[0] for r in df.select(partition).distinct().toLocalIterator()]


def partitions_with_keys(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], partition: str, besides: list | None = None) -> list:
    """Partitions of the table at ``path`` that may hold a key of ``batch``, by the stored filters; not those in ``besides``.

    Keys are asked only of filters whose key ranges meet the batch's.  A partition without filters (a table from before there were any) gets them first.
    """
    without = _names(spark, path, partition) - _names(spark, f"{path}/{keyfilters.FOLDER}", partition)
    if without:
        folders = [f"{path}/{name}" for name in sorted(without)]
        rows = spark.read.schema(batch.schema).option("basePath", path).parquet(*folders)
        keyfilters.add(keyfilters.key_filters(rows, keys, partition), path, partition)
    filters = keyfilters.read(spark, path, batch, keys, partition)
    if besides:
        filters = filters.where(~reduce(or_, [F.col(partition).eqNullSafe(F.lit(v)) for v in besides]))
    filters, batch = keyfilters.within_range(filters, batch, keys[0])
    if filters is None:
        return []
    return _values(keyfilters.partitions_named(filters, batch, keys, partition), partition)


def rows_with_keys(spark: SparkSession, path: str, wanted: DataFrame, keys: list[str], partition: str, schema) -> DataFrame:
    """Rows of an upserted table that share ``keys`` with ``wanted``; only partitions its filters name are read.

    ``keys`` are the columns the table's filters are built on.
    """
    target = spark.read.schema(schema).parquet(path)
    like = wanted.select(*keys).withColumn(partition, F.lit(None).cast(target.schema[partition].dataType))
    named = partitions_with_keys(spark, path, like, keys, partition)
    return _sharing(_in_partitions(target, partition, named), wanted, keys)


def _sharing(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is in ``other`` (NULL parts compare as equal)."""
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return df.join(other.select(*[F.col(k).alias(f"_{k}") for k in keys]), on, "left_semi")


def incremental_upsert(
    spark: SparkSession, path: str, batch: DataFrame, keys: list[str], partition: str, lookup: list[str] | None = None,
    changes: Callable[[DataFrame, DataFrame], None] | None = None, stored: bool = False,
) -> None:
    """SNK1: rewrite only the partitions the batch touches, and read only those that may hold its keys.

    Touched are the batch's own partitions and those where the target holds one of its keys.  Which may hold
    them is told by stored filters of each partition's keys (``keyfilters``); the others are not opened.
    ``lookup`` are the columns the filters are built on, if not ``keys``; they must follow from the key.
    ``changes`` is called with the rows put in and the rows they replaced, once the table holds the former.
    ``stored`` says that ``batch`` only reads what lies on disk already, so it is not stored once more.
    """
    lookup = lookup or keys
    batch = batch if stored else materialise(batch, "upsert-batch")
    if not table_exists(spark, path):
        keyfilters.add(keyfilters.key_filters(batch, lookup, partition), path, partition)
        gathered(batch, partition).write.mode("append").partitionBy(partition).parquet(path)
        if changes:
            changes(batch, batch.limit(0))
        if not stored:
            discard(batch)
        return
    target = spark.read.schema(batch.schema).parquet(path)
    own = _values(batch, partition)
    further = partitions_with_keys(spark, path, batch, lookup, partition, besides=own)
    hit = _values(_sharing(_in_partitions(target, partition, further), batch, keys), partition) if further else []
    inside = _in_partitions(target, partition, [*own, *hit])
    merged = materialise(gathered(upserted(inside, batch, keys), partition), "upsert-merged")  # files of few partitions each
    filters = materialise(keyfilters.key_filters(merged, lookup, partition), "upsert-filters")
    replaced = materialise(_sharing(inside, batch, keys), "upsert-replaced") if changes else None
    keyfilters.add(filters, path, partition)
    writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(path)
    left = set(_values(merged, partition))
    for value in hit:
        if value not in left:
            _drop_partition(spark, path, partition, value)
            _drop_partition(spark, f"{path}/{keyfilters.FOLDER}", partition, value)
    keyfilters.replace(filters, path, partition)
    if changes:
        changes(batch, replaced)
    for scratch in (*([] if stored else [batch]), merged, filters, *([replaced] if changes else [])):
        discard(scratch)


def _drop_partition(spark: SparkSession, path: str, partition: str, value) -> None:
    """Remove a partition all of whose rows moved elsewhere."""
    name = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
    delete(spark, f"{path}/{partition}={name}")


def overwrite_table(df: DataFrame, path: str, partition: str | None = None) -> None:
    """SNK2: full rebuild as a new version, safe even when ``df`` reads the table itself."""
    spark = df.sparkSession
    before = finished_versions(spark, path)
    version = f"v{(before[-1] if before else 0) + 1:06d}"
    writer = gathered(df, partition).write.partitionBy(partition) if partition else df.write
    writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{version}")
    keep = {version, f"v{before[-1]:06d}"} if before else {version}
    folder, fs = folder_of(spark, path)
    for entry in fs.listStatus(folder):
        if entry.getPath().getName() not in keep:
            fs.delete(entry.getPath(), True)


def write_if_absent(df: DataFrame, path: str) -> None:
    """SNK4: keep what is there."""
    df.write.mode("ignore").parquet(path)


def is_from_day(df: DataFrame, date: str, as_of: dt.date) -> bool:
    """The guard of SNK5: the newest row is of the day."""
    return df.agg(F.max(F.col(date).cast("date")).alias("d")).first()["d"] == as_of


def promote_stream_file(spark: SparkSession, streamed: str, batch_area: str, as_of: dt.date, date: str = "date") -> bool:
    """SNK5: copy the day's lines of the streamed table into the batch area when it has reached that day.

    A table kept by ``file_day`` is read for that day only.
    """
    if not table_exists(spark, streamed):
        return False
    df = spark.read.parquet(streamed)
    if not is_from_day(df, date, as_of):
        return False
    day = F.col("file_day" if "file_day" in df.columns else date).cast("date") == F.lit(as_of)
    df.where(day).write.mode("overwrite").parquet(f"{batch_area}/transactions_{as_of.isoformat()}")
    return True


def append_log(spark: SparkSession, path: str, rows: DataFrame, id_col: str) -> None:
    """SNK7: append log rows, one per table or run, under the next ids."""
    last = 0
    if table_exists(spark, path):
        last = spark.read.parquet(path).agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]
    nth = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))  # a handful of rows
    rows.select((F.lit(int(last)) + nth).cast("bigint").alias(id_col), "*").write.mode("append").parquet(path)
