"""Streamed twins of the batch queries.

Each replays its input, derived from the test tables, as a file stream in log
order (events by event id, the change log by change time), runs the streaming job
with ``availableNow``, and returns the rows its sink wrote. The replayed log ends
with a marker message (``END_OF_LOG``), so windows, timeouts and pending events
all leave and the result is the batch query's. Envelope logs also bring late rows
(old events once more, before the marker), which the watermark drops.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import format_ts, to_wall_time, ts_to_millis
from ..operators import changelog as cl
from ..operators import dims, parse, windows
from ..schemas import STATISTICS_TYPES
from ..session import materialize
from ..sinks import KeyedLog
from ..sources import domain
from ..streaming import feeds, jobs, stateful
from ..streaming.maintained import MaintainedTotals, signed_rows_stream
from ..streaming.running import RunningTotals
from .presets import FIXTURE as P
from .queries import ORDER_IMAGE, area_dimension, change_store, city_totals_of, typed_state

NO_DELAY = "0 seconds"
LATE_DAYS = 21
END_MS = int(jobs.END_OF_LOG.replace(tzinfo=dt.UTC).timestamp() * 1000)
END_TEXT = jobs.END_OF_LOG.isoformat(sep=" ")


# ------------------------------------------------------------ replayed logs

def _marker(spark: SparkSession, value) -> DataFrame:
    """A message log's last message: ``value`` (a column) at ``END_OF_LOG``."""
    return spark.range(1).select(F.lit(-1).cast("bigint").alias("offset"), value.alias("value"))


def envelope_log(spark: SparkSession, sf: str, path: str, order=None) -> str:
    """Event envelopes in log order, late rows (every 50th event, if more than
    ``LATE_DAYS`` old by the end of the log), the end marker."""
    envelopes = domain.event_envelopes(spark, sf)
    times = domain.table(spark, sf, "events").select(F.col("event_id").alias("offset"), "ts")
    last = times.agg(F.max("ts").alias("last"))
    old = (times.join(last).where((F.col("offset") % 50 == 1) & (
        F.col("ts") < F.col("last") - F.expr(f"INTERVAL {LATE_DAYS} DAYS"))).select("offset"))
    end = F.to_json(F.struct(
        F.array(F.struct(F.lit("ad").alias("name"),
                         F.struct(F.lit("0").alias("product_id")).alias("json"),
                         F.lit(END_MS).alias("time"))).alias("lagou_event"),
        F.struct(F.lit("").alias("area"), F.lit("").alias("uid"),
                 F.lit("").alias("channel")).alias("attr")))
    return feeds.write_feed(envelopes, path, F.col("offset") if order is None else order, tail=[
        envelopes.join(old, "offset", "left_semi"), _marker(spark, end)])


def status_line_log(spark: SparkSession, sf: str, path: str) -> str:
    """Order status lines in log order, the end marker (a created order)."""
    return feeds.write_feed(domain.order_status_lines(spark, sf), path, F.col("offset"), tail=[
        _marker(spark, F.lit(f",1,{END_TEXT},0"))])


def change_log(spark: SparkSession, sf: str, path: str) -> str:
    """The change log in change-time order, the end marker (an inserted order)."""
    row = F.create_map(F.lit("o_orderdate"), F.lit(END_TEXT), F.lit("o_custkey"), F.lit("0"))
    end = F.to_json(F.struct(
        F.array(row).alias("data"), F.lit(domain.CHANGE_DATABASE).alias("database"),
        F.lit(END_MS).alias("es"), F.lit(0).alias("id"), F.array(F.lit("o_orderkey")).alias("pkNames"),
        F.lit(domain.CHANGE_TABLE).alias("table"), F.lit("INSERT").alias("type")))
    with feeds.kept(domain.change_orders(spark, sf)) as orders:
        return feeds.write_feed(domain.change_rows(orders), path, "es", tail=[_marker(spark, end)],
                                shape=domain.change_messages)


def _timed_log(df: DataFrame, path: str, key: str, order) -> str:
    """Rows (key, ..., ts) with their times as text, in time order, the end marker."""
    text = df.withColumn("ts", F.col("ts").cast("string"))
    end = text.sparkSession.range(1).select(*[
        F.lit(END_TEXT if c == "ts" else -1).cast(kind).alias(c) for c, kind in text.dtypes])
    return feeds.write_feed(text, path, order, tail=[end])


def _replayed(spark: SparkSession, folder: str, schema: str = jobs.VALUE_SCHEMA, name: str = "log") -> DataFrame:
    feed = feeds.feed_path(folder, name)
    return jobs.json_lines_source(spark, feed, feeds.batch_files(spark, feed), schema)


def _envelope_stream(spark: SparkSession, sf: str, name: str, order=None) -> tuple[DataFrame, str]:
    folder = feeds.run_folder(spark, name)
    envelope_log(spark, sf, feeds.feed_path(folder), order)
    return _replayed(spark, folder), folder


def stream_ad_click_sliding(spark, sf):
    """A3 on a stream: sliding counts per product, emitted as windows close; panes enter and
    leave a running total by timers (W8). The log is out of order by up to 20 events, which the watermark's delay allows for (W4)."""
    scrambled = F.col("offset") + F.pmod(F.col("offset") * 7919, F.lit(20))
    src, folder = _envelope_stream(spark, sf, "ad_click_sliding", scrambled)
    width, slide = P["ad_window"]
    out = feeds.drain_to_parquet(jobs.ad_click_counts(src, width, slide, "3 days"), folder)
    return out.select("product_id", "window_start", "window_end",
                      format_ts("window_end").alias("end_time"), "click_count")


def stream_ad_click_sliding_panes(spark, sf):
    """A3 on a stream in log order: pane counts chained into sliding windows."""
    src, folder = _envelope_stream(spark, sf, "ad_click_sliding_panes")
    width, slide = P["ad_window"]
    out = feeds.drain_to_parquet(jobs.ad_click_counts(src, width, slide, NO_DELAY), folder)
    return out.select("product_id", "window_start", "window_end",
                      format_ts("window_end").alias("end_time"), "click_count")


def stream_blacklist_tumbling(spark, sf):
    """A4 + P10 on a stream."""
    src, folder = _envelope_stream(spark, sf, "blacklist_tumbling")
    job = jobs.blacklist_counts(src, P["blacklist_window"], P["blacklist_threshold"], NO_DELAY)
    out = feeds.drain_to_parquet(job, folder)
    return out.select("uid", "product_id", "window_start", "window_end",
                      format_ts("window_end").alias("end_time"), "click_count")


def stream_channel_users(spark, sf):
    """A5 on a stream: distinct users deduplicated under the watermark, then counted."""
    src, folder = _envelope_stream(spark, sf, "channel_users")
    out = feeds.drain_to_parquet(jobs.channel_users(src, P["channel_window"], NO_DELAY), folder)
    return out.select("channel", "window_start", "window_end", "user_count")


CLOCKED = "offset bigint, value string, arrived string"


def _clocked_feed(spark, rows, path, at, end, shape=None):
    """Messages in the order of a fed clock, which shows ``at`` (seconds)."""
    def stamped(clocked):
        arrived = F.date_format(F.timestamp_seconds("at_clock"), "yyyy-MM-dd HH:mm:ss").alias("arrived")
        clocked = shape(clocked, "at_clock") if shape else clocked
        return clocked.select("offset", "value", arrived)

    rows = rows.withColumn("at_clock", at)
    end = end.withColumn("arrived", F.lit(END_TEXT))
    if shape:
        return feeds.write_feed(rows, path, "at_clock", tail=[end], shape=stamped)
    return feeds.write_feed(stamped(rows), path, F.col("arrived"), tail=[end])


def stream_channel_users_processing(spark, sf):
    """A5 by processing time (W2) with a fed clock: a window closes when the clock passes it."""
    folder = feeds.run_folder(spark, "channel_users_processing")
    times = domain.table(spark, sf, "events").select(F.col("event_id").alias("offset"), F.col("ts").alias("at"))
    envelopes = domain.event_envelopes(spark, sf).join(times, "offset")
    end = F.lit('{"lagou_event": [], "attr": {}}')
    clock = F.unix_seconds(F.col("at").cast("timestamp")) + F.col("offset") * 7919 % 7 * 3600
    _clocked_feed(spark, envelopes, feeds.feed_path(folder), clock, _marker(spark, end))
    src = _replayed(spark, folder, CLOCKED)
    out = feeds.drain_to_parquet(jobs.channel_users_processing(src, P["channel_window"], "arrived"), folder)
    return out.select("channel", "window_start", "window_end", "user_count")


def _click_browse_streams(spark, sf, name):
    folder = feeds.run_folder(spark, name)
    for kind, side_name in (("click", "clicks"), ("view", "browses")):
        log = domain.click_log(spark, sf, kind)
        _timed_log(log, feeds.feed_path(folder, side_name), "event_id", F.col("event_id"))
    schema = "user_id bigint, event_id bigint, ts string"

    def side(side_name, key, id_col, ts_col):
        return (_replayed(spark, folder, schema, side_name)
                .select(F.col("user_id").alias(key), F.col("event_id").alias(id_col),
                        F.col("ts").cast("timestamp_ntz").alias(ts_col)))

    return (side("clicks", "user_id", "click_id", "click_ts"),
            side("browses", "b_user_id", "browse_id", "browse_ts"), folder)


def stream_click_browse_interval(spark, sf):
    """J4 between two streams (clicks, browses), state bounded by both watermarks."""
    clicks, browses, folder = _click_browse_streams(spark, sf, "click_browse_interval")
    lower, upper = P["interval_bounds"]
    job = jobs.click_browse_pairs(clicks, browses, lower, upper, NO_DELAY)
    return feeds.drain_to_parquet(job, folder)


def stream_click_browse_window(spark, sf):
    """J5 between two streams: pairs in the same tumbling window."""
    clicks, browses, folder = _click_browse_streams(spark, sf, "click_browse_window")
    job = jobs.click_browse_windows(clicks, browses, P["window_join_width"], NO_DELAY)
    return feeds.drain_to_parquet(job, folder)


def _order_outcomes(spark, sf, name):
    folder = feeds.run_folder(spark, name)
    status_line_log(spark, sf, feeds.feed_path(folder))
    src = _replayed(spark, folder)
    rows = jobs.watermarked(parse.parse_order_lines(src, keep=["offset"]), "ts", NO_DELAY)
    job = stateful.followed_by_stream(rows, "order_id", "ts", "offset",
                                      F.col("status") == "1", F.col("status") == "2",
                                      P["pay_within"], payload="money")
    return feeds.drain_to_outputs(job, folder)


def stream_csv_orders(spark, sf):
    """S2, P8 on a stream: plain text lines, as the socket carries them."""
    folder = feeds.run_folder(spark, "csv_orders")
    domain.order_status_lines(spark, sf).select("value").write.text(feeds.feed_path(folder))
    rows = parse.parse_order_lines(jobs.text_lines_source(spark, feeds.feed_path(folder), max_files_per_trigger=4))
    return feeds.drain_to_parquet(rows, folder)


def stream_order_timeout(spark, sf):
    """J7t on a stream: a created order times out once the watermark passes its
    creation time + W with no payment (stateful, no pairs)."""
    out = _order_outcomes(spark, sf, "order_timeout").read("timeout")      # the side output (K6)
    return out.select(
        "order_id", "start_seq", to_wall_time("start_ts").alias("start_ts"), "money")


def stream_order_paid(spark, sf):
    """J7 on a stream: created orders with their first payment within W."""
    out = _order_outcomes(spark, sf, "order_paid").read("paid")            # the main output
    return out.select(
        "order_id", "start_seq", to_wall_time("start_ts").alias("start_ts"), "money",
        "end_seq", to_wall_time("end_ts").alias("end_ts"))


def stream_order_pay_match(spark, sf):
    """J6 on two streams (orders by order date, payments by first ship date):
    matches as they meet, unmatched rows once the watermark passes t + tolerance."""
    folder = feeds.run_folder(spark, "order_pay_match")
    for side_name, df in (("orders", domain.order_events(spark, sf)),
                          ("pays", domain.pay_events(spark, sf))):
        _timed_log(df, feeds.feed_path(folder, side_name), "order_id",
                   F.unix_micros(F.col("ts").cast("timestamp")))
    schema = "order_id bigint, ts string"

    def side(side_name, ts_col):
        return (_replayed(spark, folder, schema, side_name)
                .select("order_id", F.col("ts").cast("timestamp_ntz").alias(ts_col)))

    job = jobs.order_pay_outcomes(side("orders", "order_ts"), side("pays", "pay_ts"),
                                  P["match_tolerance"], NO_DELAY)
    outputs = feeds.drain_to_outputs(job, folder)
    # the main output and the two side outputs (K6), each from its own folder
    sides = [outputs.read(o).withColumn("outcome", F.lit(o)) for o in ("matched", "unmatched_order", "unmatched_pay")]
    return sides[0].unionByName(sides[1]).unionByName(sides[2])


def _static_dimension(spark, sf):
    """The area dimension, built once and kept for the life of the stream (the
    static side of a stream x static join is otherwise re-read every batch)."""
    return materialize(area_dimension(spark, sf))


def _typed_order_stream(spark, sf, folder):
    """Change log in change-time order -> INSERTed trade orders."""
    change_log(spark, sf, feeds.feed_path(folder))
    src = _replayed(spark, folder)
    changes = parse.filter_database(parse.parse_changes(src, types=STATISTICS_TYPES, keep=["offset"],
                                                        observe="change_types"))
    orders = parse.decode_row(parse.filter_table(changes, domain.CHANGE_TABLE), {
        "order_id": ("o_orderkey", "bigint"), "cust": ("o_custkey", "bigint"),
        "total_money": ("o_totalprice", "double"),
        "create_time": ("o_orderdate", "timestamp_ntz")}, keep=["offset"])
    orders = orders.withColumn("area_id", F.col("cust") * 10 + domain.LEVEL_AREA)
    return jobs.watermarked(orders, "create_time", NO_DELAY)


def _city_sliding_stream(spark, sf, folder):
    joined = dims.lookup(_typed_order_stream(spark, sf, folder), _static_dimension(spark, sf),
                         "area_id", "areaid")
    return jobs.city_totals(joined, *P["order_window"])


def stream_city_order_sliding(spark, sf):
    """A2 on a stream: the change log (INSERTs) -> typed orders -> area lookup
    (stream x static) -> pane totals -> sliding totals per city."""
    folder = feeds.run_folder(spark, "city_order_sliding")
    return feeds.drain_to_parquet(_city_sliding_stream(spark, sf, folder), folder)


def stream_city_order_processing(spark, sf):
    """A2 by processing time (W2) with a fed clock, as feature 2 is run: inserted orders count
    when they are processed."""
    folder = feeds.run_folder(spark, "city_order_processing")
    end = F.lit('{"data": [], "database": "", "type": "INSERT"}')
    clock = F.unix_seconds(F.timestamp_millis("es")) + F.col("o_orderkey") * 7919 % 5 * 3600
    with feeds.kept(domain.change_orders(spark, sf)) as orders:
        _clocked_feed(spark, domain.change_rows(orders), feeds.feed_path(folder), clock, _marker(spark, end),
                      domain.change_messages)
    src = _replayed(spark, folder, CLOCKED)
    # the clock comes before any row is dropped: it also moves on messages that are not taken
    clocked = jobs.by_processing_time(src.withColumn("proc", F.lit(None).cast("timestamp_ntz")), "proc", "arrived")
    changes = parse.filter_database(parse.parse_changes(clocked, types=STATISTICS_TYPES, keep=["offset", "proc"],
                                                        observe="change_types"))
    orders = parse.decode_row(parse.filter_table(changes, domain.CHANGE_TABLE), {
        "cust": ("o_custkey", "bigint"), "total_money": ("o_totalprice", "double")}, keep=["offset", "proc"])
    orders = orders.withColumn("area_id", F.col("cust") * 10 + domain.LEVEL_AREA).withColumnRenamed(
        "proc", "create_time")
    joined = dims.lookup(orders, _static_dimension(spark, sf), "area_id", "areaid")
    return feeds.drain_to_parquet(jobs.city_totals(joined, *P["order_window"]), folder)


def stream_order_area_missing(spark, sf):
    """The J3 audit on a stream: inserted orders without an area."""
    folder = feeds.run_folder(spark, "order_area_missing")
    missing = dims.lookup_missing(_typed_order_stream(spark, sf, folder),
                                  _static_dimension(spark, sf), "area_id", "areaid", streaming=True)
    return feeds.drain_to_parquet(missing.select("order_id", "area_id", "total_money"), folder)


def serving_store(spark: SparkSession, root: str) -> KeyedLog:
    """The serving table: per key the latest window (K4)."""
    return KeyedLog(spark, root, "redis_key string, total_money double, order_count bigint, "
                    "time bigint", lambda log: dims.latest_per_key(log, "redis_key", "time"))


def serving_rows(closed: DataFrame) -> DataFrame:
    return closed.select(F.concat("province", "city").alias("redis_key"), "total_money",
                         "order_count", ts_to_millis("window_end").alias("time"))


def stream_city_serving_state(spark, sf):
    """K4 on a stream: closed sliding windows go to a keyed serving table; per
    (province, city) the later window wins."""
    folder = feeds.run_folder(spark, "city_serving_state")
    store = serving_store(spark, f"{folder}/store")
    rows = serving_rows(_city_sliding_stream(spark, sf, folder))
    feeds.replay(spark, folder, lambda: jobs.start(
        rows, "city_serving_state", f"{folder}/checkpoint", foreach_batch=store.sink(),
        partitions=feeds.replay_partitions(spark)))
    return store.read()


def totals_store(spark: SparkSession, root: str) -> KeyedLog:
    """Totals per city as a stream in update mode renews them: the last one counts."""
    return KeyedLog(
        spark, root, "city_key string, city string, province string, total_money double, "
        "order_count bigint, at timestamp, batch bigint",
        lambda log: dims.latest_per_key(
            log.withColumn("seq", F.struct("at", "batch")).drop("at", "batch"), "city_key", "seq"))


def renewed_totals(batch: DataFrame, batch_id: int) -> DataFrame:
    return batch.select(F.to_json(F.array("province", "city")).alias("city_key"), "city",
                        "province", "total_money", "order_count",
                        F.current_timestamp().alias("at"), F.lit(batch_id).cast("bigint").alias("batch"))


def stream_city_order_total(spark, sf):
    """A1 / A1b on a stream: running totals per city in update mode (the
    reference's retract stream), upserted per city into a keyed store; the
    final store holds the full-history totals."""
    folder = feeds.run_folder(spark, "city_order_total")
    joined = dims.lookup(_typed_order_stream(spark, sf, folder), _static_dimension(spark, sf),
                         "area_id", "areaid")
    totals = windows.aggregate(joined, ["city", "province"],
                               {"total_money": ("money", "total_money"),
                                "order_count": ("count", None)})
    store = totals_store(spark, f"{folder}/store")
    feeds.replay(spark, folder, lambda: jobs.start(
        totals, "city_order_total", f"{folder}/checkpoint", output_mode="update",
        foreach_batch=store.sink(renewed_totals), partitions=feeds.replay_partitions(spark)))
    return store.read().select("city", "province", "total_money", "order_count")


def _ingested(spark, sf, name, state):
    """The change log ingested by a stream into a keyed store (K1, K3)."""
    folder = feeds.run_folder(spark, name)
    change_log(spark, sf, feeds.feed_path(folder))
    src = _replayed(spark, folder)
    changes = parse.filter_database(parse.parse_changes(src, observe="change_types"))
    store = change_store(spark, f"{folder}/store", state)
    feeds.replay(spark, folder, lambda: jobs.start(
        changes.where(F.col("es") < END_MS), name, f"{folder}/checkpoint",
        foreach_batch=store.sink(lambda batch, _: cl.supported(batch)), partitions=feeds.replay_partitions(spark)))
    return store.read()


def stream_changelog_state(spark, sf):
    """K1 on a stream: micro-batches of changes go to the keyed store; its row-level
    state at the end, typed."""
    return typed_state(_ingested(spark, sf, "changelog_state", cl.row_state))


def stream_changelog_partial(spark, sf):
    """K1b on a stream: the same with column-level puts."""
    return typed_state(_ingested(spark, sf, "changelog_partial", cl.cell_state))


def stream_city_order_total_stored(spark, sf):
    """Feature 1 from the orders a stream has ingested and the store has kept."""
    kept = parse.filter_table(_ingested(spark, sf, "city_order_total_stored", cl.cell_state),
                              domain.CHANGE_TABLE)
    return city_totals_of(kept, area_dimension(spark, sf), "o_custkey", "o_totalprice")


def stream_blacklist_repeat_skip(spark, sf):
    """J8 on a stream: state variables and event-time timers (transformWithState)."""
    src, folder = _envelope_stream(spark, sf, "blacklist_repeat_skip")
    clicks = jobs.watermarked(parse.parse_ad_clicks(src, keep=["offset"]), "ts", NO_DELAY)
    job = stateful.repeated_skip_past_last_stream(
        clicks, ["uid", "product_id"], "ts", "offset", P["repeat_times"], P["repeat_within"])
    out = feeds.drain_to_parquet(job, folder)
    return out.select("uid", "product_id", "click_count", "area",
                      to_wall_time("start_ts").alias("start_ts"),
                      to_wall_time("end_ts").alias("end_ts"))


def stream_blacklist_repeat_all(spark, sf):
    """J8n on a stream: every run of k or more clicks within W (stateful)."""
    src, folder = _envelope_stream(spark, sf, "blacklist_repeat_all")
    clicks = jobs.watermarked(parse.parse_ad_clicks(src, keep=["offset"]), "ts", NO_DELAY)
    job = stateful.repeated_all_stream(
        clicks, ["uid", "product_id"], "ts", "offset", P["repeat_times"], P["repeat_within"])
    out = feeds.drain_to_parquet(job, folder)
    return out.select("uid", "product_id", "click_count", "area",
                      to_wall_time("start_ts").alias("start_ts"),
                      to_wall_time("shortest_start_ts").alias("shortest_start_ts"),
                      to_wall_time("end_ts").alias("end_ts"))


def stream_city_order_running(spark, sf):
    """A1b on a stream: each city's new total after every order (the per-row
    changelog of feature 1), as the orders arrive."""
    folder = feeds.run_folder(spark, "city_order_running")
    joined = dims.lookup(_typed_order_stream(spark, sf, folder), _static_dimension(spark, sf),
                         "area_id", "areaid")
    totals = RunningTotals(spark, f"{folder}/totals", "city string, province string", "order_id",
                           "total_money", "create_time", "offset")
    feeds.replay(spark, folder, lambda: jobs.start(
        joined, "city_order_running", f"{folder}/checkpoint", foreach_batch=totals.sink,
        partitions=feeds.replay_partitions(spark)))
    return totals.read()


def stream_city_order_total_maintained(spark, sf):
    """P11 on a stream: every change of an order takes back what it was and adds what it is; the
    totals per city are the increments of all micro-batches."""
    folder = feeds.run_folder(spark, "city_order_total_maintained")
    change_log(spark, sf, feeds.feed_path(folder))
    src = _replayed(spark, folder)
    changes = parse.filter_table(parse.filter_database(parse.parse_changes(src, observe="change_types")),
                                 domain.CHANGE_TABLE)
    signed = signed_rows_stream(changes.where(F.col("es") < END_MS), ORDER_IMAGE)
    signed = signed.withColumn("area_id", F.col("cust") * 10 + domain.LEVEL_AREA)
    joined = dims.lookup(signed, _static_dimension(spark, sf), "area_id", "areaid")
    totals = MaintainedTotals(spark, f"{folder}/totals", "city string, province string", "total_money")
    feeds.replay(spark, folder, lambda: jobs.start(
        joined, "city_order_total_maintained", f"{folder}/checkpoint", foreach_batch=totals.sink,
        partitions=feeds.replay_partitions(spark)))
    return totals.read()


STREAMED = {
    "stream_csv_orders": stream_csv_orders,
    "stream_channel_users_processing": stream_channel_users_processing,
    "stream_city_order_processing": stream_city_order_processing,
    "stream_city_order_total_maintained": stream_city_order_total_maintained,
    "stream_ad_click_sliding": stream_ad_click_sliding,
    "stream_ad_click_sliding_panes": stream_ad_click_sliding_panes,
    "stream_blacklist_tumbling": stream_blacklist_tumbling,
    "stream_channel_users": stream_channel_users,
    "stream_click_browse_interval": stream_click_browse_interval,
    "stream_click_browse_window": stream_click_browse_window,
    "stream_order_timeout": stream_order_timeout,
    "stream_order_paid": stream_order_paid,
    "stream_order_pay_match": stream_order_pay_match,
    "stream_city_order_sliding": stream_city_order_sliding,
    "stream_city_serving_state": stream_city_serving_state,
    "stream_city_order_total": stream_city_order_total,
    "stream_city_order_running": stream_city_order_running,
    "stream_order_area_missing": stream_order_area_missing,
    "stream_city_order_total_stored": stream_city_order_total_stored,
    "stream_changelog_state": stream_changelog_state,
    "stream_changelog_partial": stream_changelog_partial,
    "stream_blacklist_repeat_skip": stream_blacklist_repeat_skip,
    "stream_blacklist_repeat_all": stream_blacklist_repeat_all,
}
