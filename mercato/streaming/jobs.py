"""Structured Streaming versions of the warehouse jobs.

The jobs reuse the batch operators. What differs on a stream:

* event times are cast from TIMESTAMP_NTZ to TIMESTAMP and watermarked
  (``withWatermark`` refuses NTZ); the watermark is set *before* any branch so
  both sides of a pattern share one clock;
* ``count_distinct`` and ``left_anti`` are refused, so distinct counts
  deduplicate under the watermark first and timeouts are a left outer join
  whose unmatched rows appear once the watermark passes ``start + W``;
* windowed joins carry the raw time as NTZ, since a second event-time column
  is refused next to the window.

Results match the batch operators on rows whose windows / timeouts are closed
by the watermark (Spark, like the reference, emits a window in append mode only
after the watermark passes its end). A finite log that ends with a message dated
``END_OF_LOG`` closes all of them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import duration
from ..functions.time import to_event_time, to_wall_time
from ..operators import joins, parse, windows
from . import stateful

VALUE_SCHEMA = "offset bigint, value string"
# later than any event; a message of this time only moves the watermark
END_OF_LOG = dt.datetime(2200, 1, 1)


# ----------------------------------------------------------------- sources

def json_lines_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                      schema: str = VALUE_SCHEMA) -> DataFrame:
    """Messages as JSON lines ``{"offset": n, "value": "<message>"}`` (S1 stand-in).

    The same ``value`` column a Kafka source yields after ``cast(value as string)``.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "latest") -> DataFrame:
    """Kafka topic of UTF-8 messages (S1); needs the Kafka connector on the classpath."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .load()
            .select(F.col("offset"), F.col("value").cast("string").alias("value")))


def text_lines_source(spark: SparkSession, path: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Plain text lines, one record per line (S2: replaces the socket source)."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


# ----------------------------------------------------------------- helpers

def watermarked(df: DataFrame, ts: str, delay) -> DataFrame:
    """Event time as TIMESTAMP with a bounded-lateness watermark.

    Behind the watermark, rows without a time (unparsable text) and the end
    marker go. How many had no time is the metric ``no_<ts>`` of the query's
    progress. The filter names the event time, so Spark keeps it behind the
    watermark.
    """
    timed = (df.withColumn(ts, to_event_time(ts))
             .observe(f"no_{ts}", F.count_if(F.col(ts).isNull()).alias("dropped"))
             .withWatermark(ts, duration.text(delay)))
    return timed.where(F.col(ts) < F.lit(END_OF_LOG).cast("timestamp"))


def by_processing_time(df: DataFrame, ts: str, clock: str | None = None) -> DataFrame:
    """Processing-time mode (W2): ``ts`` is when a row is processed, and the watermark follows it
    without delay, so a window closes when the clock passes its end.

    Without ``clock`` that is the micro-batch's current time. ``clock`` names a column that
    tells the time instead (an arrival stamp, or a test's clock): the windows of a replayed log
    are then the same every time. The event time is given up, as the reference's jobs do.
    """
    now = F.current_timestamp() if clock is None else F.col(clock).cast("timestamp")
    return watermarked(df.withColumn(ts, now.cast("timestamp_ntz")), ts, "0 seconds")


def _wall(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, to_wall_time(c))
    return df


# ----------------------------------------------------------------- jobs

def ad_click_counts(envelopes: DataFrame, width, slide, delay) -> DataFrame:
    """Feature 3: clicks per product over sliding windows (P5, P9, A3). Clicks are counted
    per pane, a pane enters and leaves the windows' total once."""
    clicks = watermarked(parse.parse_ad_clicks(envelopes, keep=["offset"]), "ts", delay)
    return stateful.sliding_totals_stream(clicks, "ts", ["product_id"], {"click_count": ("count", None)}, width, slide)


def ad_click_counts_copied(envelopes: DataFrame, width, slide, delay) -> DataFrame:
    """Feature 3 with ``F.window``, which copies a click to each of its windows; for slides that
    do not divide the width."""
    clicks = watermarked(parse.parse_ad_clicks(envelopes, keep=["offset"]), "ts", delay)
    out = windows.window_aggregate(clicks, "ts", ["product_id"],
                                   {"click_count": ("count", None)}, width, slide)
    return _wall(out, "window_start", "window_end")


def city_totals(orders: DataFrame, width, slide) -> DataFrame:
    """Feature 2 on a stream: watermarked, joined orders are totalled per city and pane, a
    pane enters and leaves the sliding windows' totals once (A2)."""
    return stateful.sliding_totals_stream(
        orders, "create_time", ["city", "province"],
        {"total_money": ("money", "total_money"), "order_count": ("count", None)}, width, slide)


def blacklist_counts(envelopes: DataFrame, width, threshold: int, delay) -> DataFrame:
    """Feature 4 (window): clicks per (user, product) and tumbling window, >= k (A4, P10)."""
    clicks = watermarked(parse.parse_ad_clicks(envelopes, keep=["offset"]), "ts", delay)
    out = windows.window_aggregate(clicks, "ts", ["uid", "product_id"],
                                   {"click_count": ("count", None)}, width)
    return _wall(windows.at_least(out, "click_count", threshold), "window_start", "window_end")


def channel_users(envelopes: DataFrame, width, delay) -> DataFrame:
    """Feature 5: exact distinct users per channel and tumbling window (A5)."""
    return _users_of(watermarked(parse.parse_channels(envelopes, keep=["offset"]), "ts", delay), width)


def channel_users_processing(envelopes: DataFrame, width, clock: str | None = None) -> DataFrame:
    """Feature 5 by processing time, as the reference runs it."""
    keep = ["offset"] if clock is None else ["offset", clock]
    return _users_of(by_processing_time(parse.parse_channels(envelopes, keep=keep), "ts", clock), width)


def _users_of(ch: DataFrame, width) -> DataFrame:
    out = windows.distinct_count(ch, "ts", ["channel"], "uid", width, streaming=True)
    return _wall(out, "window_start", "window_end")


def click_browse_pairs(clicks: DataFrame, browses: DataFrame, lower, upper, delay) -> DataFrame:
    """Interval join of two streams (J4), bounded state through both watermarks."""
    c = watermarked(clicks, "click_ts", delay)
    b = watermarked(browses, "browse_ts", delay)
    out = joins.interval_join(c, b, "user_id", "b_user_id", "click_ts", "browse_ts",
                              lower, upper)
    return _wall(out.select("user_id", "click_id", "click_ts", "browse_id", "browse_ts"),
                 "click_ts", "browse_ts")


def click_browse_windows(clicks: DataFrame, browses: DataFrame, width, delay) -> DataFrame:
    """Tumbling-window join of two streams.

    The window is the event-time column of each side and part of the join key,
    so state is dropped once the watermark passes the window end; the raw
    times are carried as TIMESTAMP_NTZ (a second event-time column is refused).
    """
    w = duration.text(width)
    c = watermarked(clicks, "click_ts", delay)
    c = c.select("user_id", "click_id", to_wall_time("click_ts").alias("click_ts"),
                 F.window("click_ts", w).alias("_lw"))
    b = watermarked(browses, "browse_ts", delay)
    b = b.select("b_user_id", "browse_id", to_wall_time("browse_ts").alias("browse_ts"),
                 F.window("browse_ts", w).alias("_rw"))
    j = c.join(b, (F.col("user_id") == F.col("b_user_id")) & (F.col("_lw") == F.col("_rw")))
    return j.select("user_id", "click_id", "click_ts", "browse_id", "browse_ts",
                    to_wall_time(F.col("_lw.start")).alias("window_start"),
                    to_wall_time(F.col("_lw.end")).alias("window_end"))


def order_pay_outcomes(orders: DataFrame, pays: DataFrame, tolerance, delay) -> DataFrame:
    """Two-stream match with timeout (J6); unmatched rows leave after the watermark."""
    return stateful.match_with_timeout_stream(
        watermarked(orders, "order_ts", delay), watermarked(pays, "pay_ts", delay), "order_id",
        "order_ts", "pay_ts", tolerance)


def order_pay_arrivals(orders: DataFrame, pays: DataFrame, tolerance, delay) -> DataFrame:
    """The same as the reference's two slots take the rows, in arrival order (J6q)."""
    return stateful.match_in_arrival_order_stream(
        watermarked(orders, "order_ts", delay), watermarked(pays, "pay_ts", delay), "order_id",
        "order_ts", "pay_ts", "offset", tolerance)


def start(df: DataFrame, name: str, checkpoint: str, output_mode: str = "append",
          sink: str = "memory", foreach_batch=None, available_now: bool = True,
          partitions: int | None = None):
    """Start a query with a checkpoint (W10); ``foreach_batch`` for keyed stores,
    ``partitions`` for its state (fixed for the life of the checkpoint)."""
    from .feeds import state_partitions

    writer = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if foreach_batch is not None:
        writer = writer.foreachBatch(foreach_batch)
    else:
        writer = writer.format(sink).queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    with state_partitions(df.sparkSession, partitions, df):
        return writer.start()
