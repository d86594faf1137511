"""Run the warehouse's jobs: ``spark-submit -m mercato.cli <job> [options]``.

One sub-command per job of the warehouse, built from the library's operators:

=====================  ==================================================  ==========
job                    what it does                                        writes
=====================  ==================================================  ==========
area-dimension         area tree (id, name, pid) -> flattened dimension    store
ingest                 change log -> keyed store, a folder per table       store
city-totals            change log INSERTs x dimension -> totals per city   store
city-totals-stored     ingested orders x dimension -> totals per city      store
city-running           INSERTs, each city's new total after every order    Parquet
city-sliding           same, sliding windows -> latest window per city     store
orders-without-area    INSERTs whose area the dimension does not have      Parquet
ad-clicks              event envelopes -> sliding clicks per product       Parquet
blacklist              event envelopes -> tumbling counts >= threshold     Parquet
blacklist-pattern      event envelopes -> k clicks within W, skip past     Parquet
blacklist-runs         event envelopes -> runs of k or more clicks in W    Parquet
channels               event envelopes -> distinct users per channel       Parquet
channel-messages       the same as message lines                           Parquet
order-timeouts         CSV order lines -> created orders not paid in W     Parquet
click-browse-interval  clicks and browses at most so far apart             Parquet
click-browse-window    clicks and browses in one window                    Parquet
order-pay-match        orders and payments, matched or timed out           Parquet
=====================  ==================================================  ==========

Streams come from Kafka (``--kafka-servers``, ``--topic``) or from a folder of
files (``--path``: JSON lines ``{"offset", "value"}``; plain text lines for
``order-timeouts``); the three two-stream jobs read JSON rows from ``--path`` and
``--other-path`` (or ``--topic`` and ``--other-topic``). Stores are append-only logs
whose state is read through ``mercato.sinks.KeyedLog``. Window sizes come from a preset (``spec``, ``literal``,
``literal-as-run``, ``fixture``). ``--available-now`` processes what is there
and stops; otherwise the query runs until stopped.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import channel_message
from .functions.time import to_wall_time
from .operators import changelog as cl
from .operators import dims, parse, windows
from .plans import presets
from .plans.queries import change_store, city_totals_of
from .plans.streamed import renewed_totals, serving_rows, serving_store, totals_store
from .schemas import STATISTICS_TYPES
from .session import prepare
from .sinks import KeyedLog
from .streaming import jobs, stateful
from .streaming.feeds import state_partitions
from .streaming.running import RunningTotals

PRESETS = {"spec": presets.SPEC, "literal": presets.LITERAL,
           "literal-as-run": presets.LITERAL_AS_RUN, "fixture": presets.FIXTURE}
CITY_JOBS = ("city-totals", "city-running", "city-sliding", "orders-without-area")
DIMENSION = ("areaid bigint, aname string, cid bigint, city string, proid bigint, "
             "province string, at timestamp")


def dimension_store(spark: SparkSession, root: str) -> KeyedLog:
    """The area dimension (K2): a rebuild appends, the last row of an area counts, and
    a running city job keeps the files it reads."""
    return KeyedLog(spark, root, DIMENSION,
                    lambda log: dims.latest_per_key(log, "areaid", "at").drop("at"))


def _source(spark: SparkSession, args, text: bool = False) -> DataFrame:
    if args.kafka_servers:
        return jobs.kafka_source(spark, args.kafka_servers, args.topic, args.starting_offsets)
    if text:
        lines = jobs.text_lines_source(spark, args.path, args.max_files_per_trigger)
        # a plain line has no log offset; equal times then keep their arrival batch order
        return lines.withColumn("offset", F.lit(0).cast("bigint"))
    return jobs.json_lines_source(spark, args.path, args.max_files_per_trigger)


def _rows(spark: SparkSession, args, schema: str, other: bool = False) -> DataFrame:
    """JSON rows of one side of a two-stream job."""
    if args.kafka_servers:
        topic = args.other_topic if other else args.topic
        values = jobs.kafka_source(spark, args.kafka_servers, topic, args.starting_offsets)
        return values.select(F.from_json("value", schema).alias("r")).select("r.*")
    return jobs.json_lines_source(spark, args.other_path if other else args.path,
                                  args.max_files_per_trigger, schema)


def _checkpoint(args) -> str:
    # by default the checkpoint sits beside the output, on the same shared storage
    return args.checkpoint or f"{args.out.rstrip('/')}/_checkpoint"


def _start(df: DataFrame, args, output_mode: str = "append", foreach_batch=None):
    writer = (df.writeStream.outputMode(output_mode)
              .option("checkpointLocation", _checkpoint(args)))
    if foreach_batch is not None:
        writer = writer.foreachBatch(foreach_batch)
    else:
        writer = writer.format("parquet").option("path", args.out)
    if args.available_now:
        writer = writer.trigger(availableNow=True)
    with state_partitions(df.sparkSession, stream=df):
        return writer.start()


def _orders(spark: SparkSession, args) -> DataFrame:
    """Change-log INSERTs of the trade-order table -> typed orders with an area id."""
    changes = parse.parse_changes(_source(spark, args), types=STATISTICS_TYPES, keep=["offset"],
                                  observe="change_types")
    changes = parse.filter_table(parse.filter_database(changes, args.database), args.table)
    return parse.decode_row(changes, {
        "order_id": (args.order_key, "bigint"), "area_id": (args.area_key, "bigint"),
        "total_money": (args.money_key, "double"), "create_time": (args.time_key, "timestamp_ntz")},
        keep=["offset"])


def run(args) -> object:
    spark = prepare(SparkSession.builder.appName(f"mercato-{args.job}").getOrCreate())
    p = PRESETS[args.preset]
    delay = args.watermark_delay or p["watermark_delay"]

    if args.job == "area-dimension":
        tree = spark.read.parquet(args.path)
        flat = dims.flatten_hierarchy(tree, level_col="level" if "level" in tree.columns else None)
        dimension_store(spark, args.out).append(flat.withColumn("at", F.current_timestamp()))
        return None

    if args.job == "ingest":
        changes = parse.filter_database(parse.parse_changes(
            _source(spark, args), observe="change_types"), args.database)
        store = change_store(spark, args.out)
        return _start(changes, args, foreach_batch=store.sink(lambda batch, _: cl.supported(batch)))

    if args.job == "city-totals-stored":
        kept = parse.filter_table(change_store(spark, args.store).read(), args.table)
        totals = city_totals_of(kept, dimension_store(spark, args.dimension).read(),
                                args.area_key, args.money_key)
        totals_store(spark, args.out).append(renewed_totals(totals, 0))
        return None

    if args.job in CITY_JOBS:
        if not (args.dimension and args.table):
            raise SystemExit("city jobs need --dimension and --table")
        dim = dimension_store(spark, args.dimension).read()
        orders = jobs.watermarked(_orders(spark, args), "create_time", delay)
        if args.job == "orders-without-area":
            missing = dims.lookup_missing(orders, dim, "area_id", "areaid", streaming=True)
            return _start(missing.withColumn("create_time", to_wall_time("create_time")), args)
        joined = dims.lookup(orders, dim, "area_id", "areaid")
        if args.job == "city-totals":
            totals = windows.aggregate(joined, ["city", "province"],
                                       {"total_money": ("money", "total_money"),
                                        "order_count": ("count", None)})
            store = totals_store(spark, args.out)
            return _start(totals, args, output_mode="update",
                          foreach_batch=store.sink(renewed_totals))
        if args.job == "city-running":
            totals = RunningTotals(spark, args.out, "city string, province string", "order_id",
                                   "total_money", "create_time", "offset", run=_checkpoint(args))
            return _start(joined, args, foreach_batch=totals.sink)
        closed = jobs.city_totals(joined, *p["order_window"])
        return _start(serving_rows(closed), args, foreach_batch=serving_store(spark, args.out).sink())

    if args.job == "ad-clicks":
        width, slide = p["ad_window"]
        return _start(jobs.ad_click_counts(_source(spark, args), width, slide, delay), args)
    if args.job == "blacklist":
        return _start(jobs.blacklist_counts(_source(spark, args), p["blacklist_window"],
                                            p["blacklist_threshold"], delay), args)
    if args.job == "blacklist-pattern":
        clicks = jobs.watermarked(parse.parse_ad_clicks(_source(spark, args), keep=["offset"]),
                                  "ts", delay)
        out = stateful.repeated_skip_past_last_stream(
            clicks, ["uid", "product_id"], "ts", "offset", p["repeat_times"], p["repeat_within"])
        return _start(out.withColumn("start_ts", to_wall_time("start_ts"))
                      .withColumn("end_ts", to_wall_time("end_ts")), args)
    if args.job == "blacklist-runs":
        clicks = jobs.watermarked(parse.parse_ad_clicks(_source(spark, args), keep=["offset"]),
                                  "ts", delay)
        out = stateful.repeated_all_stream(
            clicks, ["uid", "product_id"], "ts", "offset", p["repeat_times"], p["repeat_within"])
        return _start(out.withColumns({c: to_wall_time(c) for c in (
            "start_ts", "shortest_start_ts", "end_ts")}), args)
    if args.job in ("channels", "channel-messages"):
        users = jobs.channel_users(_source(spark, args), p["channel_window"], delay)
        if args.job == "channel-messages":
            users = users.select("channel", "window_start",
                                 channel_message("channel", "user_count").alias("message"))
        return _start(users, args)
    if args.job.startswith("click-browse"):
        schema = "user_id bigint, event_id bigint, ts timestamp_ntz"
        clicks = _rows(spark, args, schema).selectExpr(
            "user_id", "event_id click_id", "ts click_ts")
        browses = _rows(spark, args, schema, other=True).selectExpr(
            "user_id b_user_id", "event_id browse_id", "ts browse_ts")
        if args.job == "click-browse-interval":
            return _start(jobs.click_browse_pairs(clicks, browses, *p["interval_bounds"], delay), args)
        return _start(jobs.click_browse_windows(clicks, browses, p["window_join_width"], delay), args)
    if args.job == "order-pay-match":
        schema = "order_id bigint, ts timestamp_ntz"
        orders = _rows(spark, args, schema).withColumnRenamed("ts", "order_ts")
        pays = _rows(spark, args, schema, other=True).withColumnRenamed("ts", "pay_ts")
        return _start(jobs.order_pay_outcomes(orders, pays, p["match_tolerance"], delay), args)
    if args.job == "order-timeouts":
        rows = jobs.watermarked(parse.parse_order_lines(_source(spark, args, text=True),
                                                        keep=["offset"]), "ts", delay)
        out = stateful.followed_by_stream(rows, "order_id", "ts", "offset",
                                          F.col("status") == "1", F.col("status") == "2",
                                          p["pay_within"], payload="money")
        return _start(out.where(F.col("outcome") == "timeout")
                      .select("order_id", "start_seq", to_wall_time("start_ts").alias("start_ts"),
                              "money"), args)
    raise SystemExit(f"unknown job {args.job}")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="mercato", description=__doc__.split("\n\n")[0])
    ap.add_argument("job", choices=[
        "area-dimension", "ingest", *CITY_JOBS, "city-totals-stored", "ad-clicks", "blacklist",
        "blacklist-pattern", "blacklist-runs", "channels", "channel-messages", "order-timeouts",
        "click-browse-interval", "click-browse-window", "order-pay-match"])
    ap.add_argument("--path", help="input folder (files) or Parquet table (area-dimension)")
    ap.add_argument("--kafka-servers")
    ap.add_argument("--topic")
    ap.add_argument("--other-path", help="second input folder (two-stream jobs)")
    ap.add_argument("--other-topic", help="second topic (two-stream jobs)")
    ap.add_argument("--store", help="ingested store (city-totals-stored)")
    ap.add_argument("--starting-offsets", default="latest")
    ap.add_argument("--max-files-per-trigger", type=int)
    ap.add_argument("--out", required=True, help="output folder or store")
    ap.add_argument("--checkpoint", help="checkpoint folder on shared storage")
    ap.add_argument("--dimension", help="area dimension store (city jobs)")
    ap.add_argument("--preset", default="spec", choices=sorted(PRESETS))
    ap.add_argument("--watermark-delay")
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--table", help="trade-order table name in the change log (city jobs)")
    # Fixed defaults (the reference's database name and trade-order cell names).
    ap.add_argument("--database", default="dwshow")
    ap.add_argument("--order-key", default="orderId")
    ap.add_argument("--area-key", default="areaId")
    ap.add_argument("--money-key", default="totalMoney")
    ap.add_argument("--time-key", default="createTime")
    return ap


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    query = run(args)
    if query is not None:
        query.awaitTermination()


if __name__ == "__main__":
    main()
