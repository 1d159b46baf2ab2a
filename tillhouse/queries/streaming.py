"""STR*, SRC7, SNK3, SNK5: streams run to the end of their input, then compared with a batch form."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tillhouse.functions.dates import utc_clock
from tillhouse.queries.registry import query
from tillhouse.session import shared_folder
from tillhouse.sources import standin
from tillhouse.sources.sinks import promote_stream_file
from tillhouse.streaming import live
from tillhouse.streaming.compaction import DailyFiles

c = F.col


def _area(spark) -> str:
    return f"{shared_folder(spark)}/live-{uuid.uuid4().hex}"


def _messages(spark, sf, area):
    """The live messages as files, with the columns a topic has."""
    standin.live_messages(spark, sf).select("value", c("ts").cast("timestamp").alias("timestamp")).write.parquet(f"{area}/topic")
    return live.file_messages(spark, f"{area}/topic")


def _collected(stream, area, spark):
    """Run a stateless or de-duplicating stream into files and read them back."""
    q = stream.writeStream.format("parquet").option("path", f"{area}/out").option("checkpointLocation", f"{area}/checkpoint")
    q.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{area}/out")


TYPED = [
    "transaction_id", "date", "time", "datetime", "customer_id", "store_id", "payment_method", "total_amount",
    "items_count", "status", "product_id", "quantity", "line_total",
]


@query("src7_message_source")
def src7(spark, sf):
    area = _area(spark)
    return _collected(live.typed_lines(_messages(spark, sf, area)).select(*TYPED), area, spark)


@query("str1_source")
def str1(spark, sf):
    area = _area(spark)
    return _collected(_messages(spark, sf, area), area, spark).select(
        F.get_json_object("value", "$.transaction_id").alias("transaction_id"), F.get_json_object("value", "$.product_id").alias("product_id")
    )


@query("str2_typed_parse")
def str2(spark, sf):
    area = _area(spark)
    stream = live.typed_lines(_messages(spark, sf, area))
    return _collected(stream.select("transaction_id", "product_id", "date", "datetime", "total_amount", "quantity"), area, spark)


@query("str3_daily_files")
def str3(spark, sf):
    area = _area(spark)
    stream = live.typed_lines(_messages(spark, sf, area))
    live.write_daily_files(stream, f"{area}/days", f"{area}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{area}/days").groupBy(c("file_day").alias("date")).agg(
        F.count("*").alias("lines"), F.count_if(c("file_day") != c("date")).alias("misfiled")
    )


@query("snk3_stream_to_parquet")
def snk3(spark, sf):
    area = _area(spark)
    stream = live.typed_lines(_messages(spark, sf, area))
    live.write_daily_files(stream, f"{area}/days", f"{area}/checkpoint", available_now=True).awaitTermination()
    files = DailyFiles(spark, f"{area}/days", f"{area}/packed", stream.schema)
    files.pack()
    return files.read().select("transaction_id", "product_id", "date", "total_amount")


@query("str4_distinct_lines")
def str4(spark, sf):
    area = _area(spark)
    stream = live.distinct_lines(live.typed_lines(_messages(spark, sf, area)))
    return _collected(stream.select("transaction_id", "product_id", "total_amount"), area, spark)


def _figures(spark, sf):
    area = _area(spark)
    figures = live.live_figures(_messages(spark, sf, area), standin.live_stores(spark, sf))
    live.write_figures(figures, f"{area}/figures", f"{area}/checkpoint", available_now=True).awaitTermination()
    return live.read_figures(spark, f"{area}/figures")


@query("str5_live_store_figures")
def str5(spark, sf):
    return live.with_averages(_figures(spark, sf)).withColumn("window_start", utc_clock(c("window_start")))


@query("str5_live_totals")
def str5_totals(spark, sf):
    return live.window_totals(_figures(spark, sf)).withColumn("window_start", utc_clock(c("window_start")))


@query("str6_stream_static_enrich")
def str6(spark, sf):
    from tillhouse.operators.streams import enrich_with_stores

    area = _area(spark)
    stream = enrich_with_stores(live.typed_lines(_messages(spark, sf, area)), standin.live_stores(spark, sf))
    return _collected(stream.select("transaction_id", "store_id", "store_name"), area, spark)


@query("str7_closed_windows")
def str7(spark, sf):
    area = _area(spark)
    figures = live.live_figures(_messages(spark, sf, area), standin.live_stores(spark, sf), width="1 hour")
    live.write_closed_windows(figures, f"{area}/windows", f"{area}/checkpoint", available_now=True).awaitTermination()
    return live.with_averages(spark.read.parquet(f"{area}/windows")).withColumn("window_start", utc_clock(c("window_start")))


def _closed(spark, sf, figures_of):
    """Figures of windows the watermark has passed."""
    area = _area(spark)
    figures = figures_of(live.live_transactions(_messages(spark, sf, area), standin.live_stores(spark, sf)))
    live.write_closed_windows(figures, f"{area}/windows", f"{area}/checkpoint", available_now=True).awaitTermination()
    return live.with_averages(spark.read.parquet(f"{area}/windows")).withColumn("window_start", utc_clock(c("window_start")))


@query("str7_sliding_windows")
def str7_sliding(spark, sf):
    return _closed(spark, sf, lambda t: live.store_figures(t, "3 hours", "1 hour"))


@query("str7_session_windows")
def str7_sessions(spark, sf):
    return _closed(spark, sf, lambda t: live.session_figures(t, "45 minutes"))


@query("snk5_promote_stream_file")
def snk5(spark, sf):
    area = _area(spark)
    stream = live.typed_lines(_messages(spark, sf, area))
    live.write_daily_files(stream, f"{area}/days", f"{area}/checkpoint", available_now=True).awaitTermination()
    newest = spark.read.parquet(f"{area}/days").agg(F.max("file_day").alias("d")).first()["d"]
    stale = promote_stream_file(spark, f"{area}/days", f"{area}/batch", newest + dt.timedelta(days=1))
    done = promote_stream_file(spark, f"{area}/days", f"{area}/batch", newest)
    return spark.read.parquet(f"{area}/batch/*").agg(F.count("*").alias("lines"), F.max("date").alias("newest")).select(
        "*", F.lit(stale).alias("promoted_next_day"), F.lit(done).alias("promoted_same_day")
    )
