"""The live stream: source, typed lines, daily files and store figures (STR1-STR7).

The same functions serve Kafka and a folder of files, since both deliver
``value`` and ``timestamp``.  State is bounded by the event-time watermark: the
number of rows shown before is a display limit, not a bound on time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillhouse.functions.dates import utc_instant
from tillhouse.functions.measures import money_total
from tillhouse.operators.streams import coerce_types, drop_marked_duplicates, enrich_with_stores, parse_messages
from tillhouse.streaming.figures import FOLD_EVERY, FigureStore

# Fixed values of the live feed.
TOPIC = "daily-retail-transactions"
REFRESH = "2 seconds"
LATENESS = "1 hour"
MESSAGE = "value string, timestamp timestamp"


def kafka_messages(spark: SparkSession, servers: str, topic: str = TOPIC, per_trigger: int | None = None) -> DataFrame:
    """SRC7: the topic from its first offset; needs the Kafka connector on the class path.

    A micro-batch takes all that has arrived unless ``per_trigger`` limits it.
    """
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.option("startingOffsets", "earliest").load().select(F.col("value").cast("string").alias("value"), "timestamp")


def file_messages(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """SRC7 over files with the columns of the topic."""
    reader = spark.readStream.schema(MESSAGE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def typed_lines(messages: DataFrame) -> DataFrame:
    """STR2: typed till lines; the arrival time stands in for a missing event time."""
    lines = coerce_types(parse_messages(messages))
    return lines.withColumn("event_time", F.coalesce(utc_instant(F.col("datetime")), F.col("timestamp"))).drop("timestamp")


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Lines that can't be told apart: text that isn't a message, or no transaction or product id.

    They go to an output of their own.  De-duplication leaves them out, since it
    would take all missing ids for one.
    """
    return lines.where("transaction_id is null or product_id is null")


def distinct_lines(lines: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """STR4: marked copies dropped, and lines sent again within the watermark."""
    return (
        drop_marked_duplicates(lines).where("transaction_id is not null and product_id is not null").withWatermark("event_time", lateness)
        .dropDuplicatesWithinWatermark(["transaction_id", "product_id"])
    )


def distinct_transactions(lines: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """One line per transaction, so that header amounts count once."""
    known = drop_marked_duplicates(lines).where("transaction_id is not null")
    return known.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(["transaction_id"])


def store_figures(transactions: DataFrame, width: str, slide: str | None = None) -> DataFrame:
    """STR5/STR7: figures per store and event-time window, as sums that merge; with ``slide``, a window starts that often."""
    return _figures_by(transactions, F.window("event_time", width, slide))


def session_figures(transactions: DataFrame, gap: str) -> DataFrame:
    """STR7: figures per store and session: transactions that follow one another within ``gap``."""
    return _figures_by(transactions, F.session_window("event_time", gap))


def _figures_by(transactions: DataFrame, window: Column) -> DataFrame:
    return transactions.groupBy(window.alias("w"), "store_name").agg(
        F.count("*").alias("transactions"), F.sum("total_amount").alias("total_sales"),
        F.count("total_amount").alias("priced"), F.sum("items_count").alias("items"), F.count("items_count").alias("counted"),
    ).select(F.col("w.start").alias("window_start"), "store_name", "transactions", "total_sales", "priced", "items", "counted")


def with_averages(figures: DataFrame) -> DataFrame:
    """AGG18: the displayed figures of stored sums."""
    ratio = lambda a, b: F.col(a).cast("double") / F.nullif(F.col(b).cast("double"), F.lit(0.0))
    return figures.select(
        "window_start", "store_name", "transactions", money_total(F.col("total_sales")).alias("total_sales"),
        money_total(ratio("total_sales", "priced")).alias("avg_basket"), money_total(ratio("items", "counted"), 1).alias("avg_items"),
    )


def window_totals(figures: DataFrame) -> DataFrame:
    """AGG18: all stores together, from the stored figures."""
    priced = F.nullif(F.sum("priced").cast("double"), F.lit(0.0))
    return figures.groupBy("window_start").agg(
        F.sum("transactions").alias("total_transactions"), money_total(F.sum("total_sales")).alias("total_revenue"),
        F.count("store_name").alias("active_stores"), money_total(F.sum("total_sales") / priced).alias("avg_transaction"),
    )


def live_transactions(messages: DataFrame, stores: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """STR1-STR4, STR6: messages to one line per transaction, with its store's name."""
    return distinct_transactions(enrich_with_stores(typed_lines(messages), stores), lateness)


def live_figures(messages: DataFrame, stores: DataFrame, width: str = "1 day", lateness: str = LATENESS) -> DataFrame:
    """STR1-STR6 in one: messages to figures per store and window."""
    return store_figures(live_transactions(messages, stores, lateness), width)


def write_daily_files(lines: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """SNK3/STR3: append typed lines under each row's own day.

    Offsets and the file log give each line exactly one place, also after a crash.  ``compaction.DailyFiles`` packs
    the small files of closed days.
    """
    writer = lines.withColumn("file_day", F.col("date")).writeStream.format("parquet").partitionBy("file_day")
    return _start(writer.option("path", path), checkpoint, available_now)


def write_figures(figures: DataFrame, path: str, checkpoint: str, available_now: bool = False, fold_every: int = FOLD_EVERY) -> StreamingQuery:
    """STR5: keep current figures; a trigger writes only what it changed, and a repeated one replaces its own rows."""
    def store(batch: DataFrame, epoch: int) -> None:
        FigureStore(batch.sparkSession, path, fold_every).append(batch, epoch)

    return _start(figures.writeStream.outputMode("update").foreachBatch(store), checkpoint, available_now)


def read_figures(spark: SparkSession, path: str) -> DataFrame:
    """STR5: the figures as of the last trigger."""
    return FigureStore(spark, path).current()


def write_closed_windows(figures: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """STR7: only windows the watermark has passed, appended once."""
    return _start(figures.writeStream.outputMode("append").format("parquet").option("path", path), checkpoint, available_now)


def _start(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=REFRESH)).start()
