"""Which stored partitions may hold a key: a Bloom filter and a key range per partition (SNK1).

The filters lie in ``_keys`` inside the table's folder, which readers of the table pass over, partitioned like the table.
A partition has 2 ** level blocks of ``BLOCK_BITS`` bits, so many that a key has about ``BITS_PER_KEY``; a key belongs to one
block and sets ``HASHES`` bits there.  A block is one row with its smallest and largest key, so a key is asked of a
partition by a join on level and block, and nothing but the filters is read.

A filter may name a partition in vain, never the other way round: filters of new content are added before the content is
put in place, and only replace the old ones after that.  A run that dies in between leaves both.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``bitmap_construct_agg`` makes bitmaps of this size.
BLOCK_BITS = 32768
BITS_PER_KEY = 32
HASHES = 6
FOLDER = "_keys"


def _positions(h: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(h, F.lit(i)), F.lit(BLOCK_BITS)) for i in range(HASHES)]


def _block(h: Column, level: Column) -> Column:
    """One of 2 ** level blocks, by a hash no position uses."""
    return F.pmod(F.xxhash64(h, F.lit("block")), F.call_function("shiftleft", F.lit(1).cast("long"), level))


def key_filters(rows: DataFrame, keys: list[str], partition: str) -> DataFrame:
    """``level, block, bits, low, high, empty`` of each partition in ``rows``; the range is that of the first key."""
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.count("*") * BITS_PER_KEY / BLOCK_BITS))).cast("int")
    levels = rows.groupBy(F.col(partition).alias("_of")).agg(level.alias("level"))  # a row per partition of the batch
    hashed = rows.select(partition, F.col(keys[0]).alias("first"), F.xxhash64(*keys).alias("h"))
    placed = hashed.join(F.broadcast(levels), F.col(partition).eqNullSafe(F.col("_of"))).select(
        partition, "level", "first", _block(F.col("h"), F.col("level")).alias("block"), "h",
    )
    # A bitmap per hash, put together per block: a row for each bit would have six times the rows sorted.
    blocks = placed.groupBy(partition, "level", "block").agg(
        *[F.bitmap_construct_agg(at).alias(f"bits{i}") for i, at in enumerate(_positions(F.col("h")))],
        F.min("first").alias("low"), F.max("first").alias("high"),
        F.coalesce(F.bool_or(F.col("first").isNull()), F.lit(False)).alias("empty"),
    )
    bits = F.explode(F.array(*[f"bits{i}" for i in range(HASHES)])).alias("bits")
    return blocks.select(partition, "level", "block", "low", "high", "empty", bits).groupBy(partition, "level", "block").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.first("low").alias("low"), F.first("high").alias("high"), F.first("empty").alias("empty"),
    ).select("level", "block", "bits", "low", "high", "empty", partition)


def within_range(filters: DataFrame, batch: DataFrame, key: str) -> tuple[DataFrame, DataFrame] | tuple[None, None]:
    """The filters and the rows of ``batch`` whose ranges of ``key`` meet, or None if there are no such filters."""
    first = F.col(key)
    low, high, nulls = batch.agg(F.min(first), F.max(first), F.coalesce(F.bool_or(first.isNull()), F.lit(False))).first()
    meet = F.lit(False) if low is None else F.coalesce((F.col("high") >= F.lit(low)) & (F.col("low") <= F.lit(high)), F.lit(False))
    filters = filters.where(meet | (F.col("empty") & F.lit(nulls)))
    least, most, n = filters.agg(F.min("low"), F.max("high"), F.count("*")).first()
    if n == 0:
        return None, None
    return filters, batch.where(first.isNull() if least is None else first.isNull() | first.between(F.lit(least), F.lit(most)))


def _has(bits: str, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.call_function("shiftright", at, F.lit(3)) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, F.pmod(at, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1


def partitions_named(filters: DataFrame, batch: DataFrame, keys: list[str], partition: str) -> DataFrame:
    """The partitions whose filters admit a key of ``batch``, once each."""
    asked = batch.select(F.col(keys[0]).alias("first"), F.xxhash64(*keys).alias("h"))
    levels = filters.select(F.col("level").alias("asked_level")).distinct()  # a handful
    asked = asked.crossJoin(F.broadcast(levels)).withColumn("asked_block", _block(F.col("h"), F.col("asked_level")))
    inside = F.when(F.col("first").isNull(), F.col("empty")).otherwise((F.col("first") >= F.col("low")) & (F.col("first") <= F.col("high")))
    admitted = reduce(lambda a, b: a & b, [_has("bits", at) for at in _positions(F.col("h"))])
    on = (F.col("level") == F.col("asked_level")) & (F.col("block") == F.col("asked_block")) & inside & admitted
    return filters.join(asked, on, "left_semi").select(partition).distinct()


def add(filters: DataFrame, path: str, partition: str) -> None:
    """Beside what is there: both count."""
    filters.write.mode("append").partitionBy(partition).parquet(f"{path}/{FOLDER}")


def replace(filters: DataFrame, path: str, partition: str) -> None:
    """Instead of what the same partitions have."""
    writer = filters.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(f"{path}/{FOLDER}")


def read(spark: SparkSession, path: str, like: DataFrame, keys: list[str], partition: str) -> DataFrame:
    """The stored filters, with the key and partition types of ``like``."""
    kind = {f.name: f.dataType.simpleString() for f in like.schema}
    ddl = f"level int, block long, bits binary, low {kind[keys[0]]}, high {kind[keys[0]]}, empty boolean, `{partition}` {kind[partition]}"
    return spark.read.schema(ddl).parquet(f"{path}/{FOLDER}")
