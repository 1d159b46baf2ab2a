"""File scans (SRC1-SRC6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions.dates import ID_DATE
from tillhouse.sources import schemas

# How raw files are named.
MASTER_FILE = r"([^/]+)\.parquet$"
DAY_IN_FILE = r"(\d{4}-\d{2}-\d{2})"


def scan_parquet(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """SRC1: one file or folder with a declared schema."""
    return spark.read.schema(ddl).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return scan_parquet(spark, f"{sf_dir}/{name}.parquet", schemas.TABLES[name])


def scan_parquet_glob(spark: SparkSession, pattern: str, ddl: str) -> DataFrame:
    """SRC2: the daily files; ``data_created/modified`` gets a plain name."""
    source = ddl.replace("data_created_modified", "`data_created/modified`")
    df = spark.read.schema(source).parquet(pattern)
    return df.withColumnRenamed("data_created/modified", "data_created_modified")


def file_listing(spark: SparkSession, pattern: str) -> DataFrame:
    """SRC3: path, size and mtime of files; the content column is never read."""
    return spark.read.format("binaryFile").load(pattern).select(
        F.regexp_extract("path", MASTER_FILE, 1).alias("filename"),
        F.col("length").alias("size"),
        F.col("modificationTime").cast("date").alias("modified_date"),
    )


def daily_file_listing(spark: SparkSession, pattern: str) -> DataFrame:
    """SRC3 for daily files: keyed by the day in the file name."""
    day = F.regexp_extract("path", DAY_IN_FILE, 1)
    return spark.read.format("binaryFile").load(pattern).select(
        F.replace(day, F.lit("-"), F.lit("")).alias("date_key"),
        F.try_to_date(day).alias("transaction_date"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified_date"),
    )


def attach_file_metadata(df: DataFrame) -> DataFrame:
    """SRC4/JOI4: the file's own metadata, taken in the scan without a join."""
    return df.select(
        "*",
        F.regexp_extract("_metadata.file_path", MASTER_FILE, 1).alias("filename"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").cast("date").alias("modified_date"),
    )


def attach_metadata_by_key(txn: DataFrame, listing: DataFrame) -> DataFrame:
    """SRC5: keep rows whose day has a file and stamp them with its load time.

    One row per day in ``listing``: small enough for Spark's own size check to
    broadcast it, and only the columns used travel.
    """
    days = listing.select("date_key", F.col("modified_date").alias("_loaded_at_date"))
    keyed = txn.withColumn("date_key", F.regexp_extract("transaction_id", ID_DATE, 1))
    return keyed.join(days, "date_key").drop("date_key")


def scan_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC6: the ZIP lookup; ZIP codes stay text, with their leading zeros."""
    return spark.read.schema(schemas.ZIP_LOOKUP).csv(path, header=True)
