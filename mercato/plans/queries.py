"""Registered queries: each ``(spark, sf_dir) -> DataFrame`` over whole tables.

Names follow SURVEY 7.4; parameters come from ``presets.FIXTURE``. Every
computed column is aliased to the name its DuckDB oracle uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import duration
from ..functions.text import channel_message, match_message, split_text
from ..functions.time import format_ts, parse_text_ts, seconds_to_ts, ts_to_millis
from ..operators import changelog as cl
from ..operators import aggregates, dims, joins, parse, patterns, retract, windows
from ..schemas import AREA_DIMENSION_COLUMNS
from ..session import prepare
from ..sinks import KeyedLog
from ..sources import domain
from ..sources.keyed_scan import scan_keyed, write_keyed
from ..streaming.feeds import run_folder
from .presets import FIXTURE

P = FIXTURE
MONEY = windows.MONEY
ORDER_FIELDS = {
    "o_orderkey": ("o_orderkey", "bigint"),
    "o_custkey": ("o_custkey", "bigint"),
    "o_orderstatus": ("o_orderstatus", "string"),
    "o_totalprice": ("o_totalprice", "double"),
    "o_orderdate": ("o_orderdate", "timestamp_ntz"),
    "o_orderpriority": ("o_orderpriority", "string"),
}


# ------------------------------------------------------------ shared inputs

def area_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return dims.flatten_hierarchy(domain.area_tree(spark, sf), level_col="level")


def ad_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_ad_clicks(domain.event_envelopes(spark, sf), keep=["offset"])


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_order_lines(domain.order_status_lines(spark, sf), keep=["offset"])


def order_changes(spark: SparkSession, sf: str) -> DataFrame:
    return parse.filter_database(parse.parse_changes(domain.change_log(spark, sf)))


# ------------------------------------------------------------ feature 1: city totals

def city_order_total(spark, sf):
    """J1 + A1. Orders are first totalled per area (eager aggregation: the join
    then sees one row per area, not per order), then per city and province."""
    per_area = (domain.trade_orders(spark, sf)
                .groupBy("area_id")
                .agg(F.sum(F.col("total_money").cast(MONEY)).alias("_m"),
                     F.count(F.lit(1)).alias("_n")))
    joined = dims.lookup(per_area, area_dimension(spark, sf), "area_id", "areaid")
    return joined.groupBy("city", "province").agg(
        F.sum("_m").cast("double").alias("total_money"), F.sum("_n").alias("order_count"))


def city_order_running(spark, sf):
    """The city total after each order, in order-id order. Orders are numbered by
    the ids of their city and province; the names are looked up afterwards."""
    dim = area_dimension(spark, sf)
    joined = dims.lookup(domain.trade_orders(spark, sf), dim.select("areaid", "cid", "proid"),
                         "area_id", "areaid")
    rows = joined.select("cid", "proid", "order_id", "total_money")
    out = windows.running_totals(rows, ["cid", "proid"], "order_id",
                                 {"running_money": ("money", "total_money"),
                                  "running_count": ("count", None)})
    names = dim.select("cid", "proid", "city", "province").distinct()
    return out.join(names, ["cid", "proid"]).select(
        "city", "province", "order_id", "running_money", "running_count")


def area_flatten(spark, sf):
    """J2."""
    return area_dimension(spark, sf)


def order_area_lookup(spark, sf):
    """Orders with their city and province, from a dimension that also holds an
    older row of every other area; the last row of a key counts."""
    dim = area_dimension(spark, sf).withColumn("seq", F.lit(1))
    stale = dim.where(F.col("areaid") % 20 == 3).withColumns(
        {"city": F.lit("stale"), "province": F.lit("stale"), "seq": F.lit(0)})
    joined = dims.lookup(domain.trade_orders(spark, sf), stale.unionByName(dim),
                         "area_id", "areaid", latest_by="seq")
    return joined.select("order_id", "area_id", "city", "province", "total_money")


def order_area_missing(spark, sf):
    """J3 audit: orders whose area is not in the dimension."""
    missing = dims.lookup_missing(domain.trade_orders(spark, sf), area_dimension(spark, sf),
                                  "area_id", "areaid")
    return missing.select("order_id", "area_id", "total_money")


# ------------------------------------------------------------ feature 2: sliding city totals

def city_order_sliding(spark, sf):
    """A2: per (area, day pane) partials, joined to the dimension; per (city, province) a
    pane enters and leaves the windows as two signed rows."""
    width, slide = P["order_window"]
    orders = domain.trade_orders(spark, sf)
    pane = F.window("create_time", duration.text(slide)).start
    per_area = orders.groupBy("area_id", pane.alias("pane")).agg(
        F.sum(F.col("total_money").cast(MONEY)).alias("_m"), F.count(F.lit(1)).alias("_n"))
    joined = dims.lookup(per_area, area_dimension(spark, sf), "area_id", "areaid")
    return windows.sliding_aggregate(
        joined, "pane", ["city", "province"],
        {"total_money": ("money_sum", "_m"), "order_count": ("sum", "_n")}, width, slide)


def city_serving_state(spark, sf):
    """K4: latest window per (province, city), keyed as the serving store."""
    sliding = city_order_sliding(spark, sf)
    keyed = sliding.select(F.concat("province", "city").alias("redis_key"), "total_money", "order_count",
                           ts_to_millis("window_end").alias("time"))
    return dims.latest_per_key(keyed, "redis_key", "time")


# ------------------------------------------------------------ feature 3: ad clicks

def ad_events(spark, sf):
    """P5 + P9 + F2."""
    return ad_clicks(spark, sf).select("offset", "area", "uid", "product_id", "ts")


def _with_end(windowed):
    return windowed.select("product_id", "window_start", "window_end",
                           format_ts("window_end").alias("end_time"), "click_count")


def ad_click_sliding(spark, sf):
    """A3: clicks enter and leave the sliding windows as signed rows."""
    return _with_end(windows.sliding_aggregate(
        ad_clicks(spark, sf), "ts", ["product_id"], {"click_count": ("count", None)}, *P["ad_window"]))


def ad_click_sliding_panes(spark, sf):
    """A3 from stored panes: counts per slide-wide pane (what a job may keep instead of the
    clicks), then the windows of any width over them."""
    width, slide = P["ad_window"]
    panes = windows.window_aggregate(ad_clicks(spark, sf), "ts", ["product_id"],
                                     {"clicks": ("count", None)}, slide)
    return _with_end(windows.sliding_aggregate(
        panes, "window_start", ["product_id"], {"click_count": ("sum", "clicks")}, width, slide))


# ------------------------------------------------------------ feature 4: blacklists

def blacklist_tumbling(spark, sf):
    """A4 + P10 + F3."""
    out = windows.window_aggregate(ad_clicks(spark, sf), "ts", ["uid", "product_id"],
                                   {"click_count": ("count", None)}, P["blacklist_window"])
    out = windows.at_least(out, "click_count", P["blacklist_threshold"])
    return out.select("uid", "product_id", "window_start", "window_end",
                      format_ts("window_end").alias("end_time"), "click_count")


def blacklist_repeat_skip(spark, sf):
    """Runs of k clicks within W, skip past last."""
    return patterns.repeated_skip_past_last(
        ad_clicks(spark, sf), ["uid", "product_id"], "ts", "offset",
        P["repeat_times"], P["repeat_within"], payload=["area"])


def blacklist_repeat_all(spark, sf):
    """J8n: every run of k or more clicks within W."""
    return patterns.repeated_all(
        ad_clicks(spark, sf), ["uid", "product_id"], "ts", "offset",
        P["repeat_times"], P["repeat_within"], payload=["area"])


# ------------------------------------------------------------ feature 5: channels

def channel_events(spark, sf):
    """P6."""
    return parse.parse_channels(domain.event_envelopes(spark, sf), keep=["offset"])


def channel_users(spark, sf):
    """A5: exact distinct users per channel and tumbling window."""
    return windows.distinct_count(channel_events(spark, sf), "ts", ["channel"], "uid",
                                  P["channel_window"])


def channel_users_sliding(spark, sf):
    """A5 over sliding windows: exact distinct users from signed events."""
    return windows.sliding_distinct(channel_events(spark, sf), "ts", ["channel"], "uid", *P["channel_sliding"])


def channel_message_lines(spark, sf):
    """P14 on A5."""
    out = channel_users(spark, sf)
    return out.select("channel", "window_start",
                      channel_message("channel", "user_count").alias("message"))


# ------------------------------------------------------------ feature 6: unpaid orders

def csv_orders(spark, sf):
    """P8 + F4."""
    return order_lines(spark, sf)


def event_scalars(spark, sf):
    """numeric text to time, the parts of a line, the key of a row without one."""
    rows = domain.order_status_lines(spark, sf).withColumn("parts", split_text("value", ","))
    at = F.unix_seconds(parse_text_ts(F.col("parts")[2]).cast("timestamp")).cast("string")
    return rows.select("offset", F.size("parts").alias("n_parts"), F.col("parts")[1].alias("status"),
                       seconds_to_ts(at).alias("ts"),
                       parse.row_key(F.array().cast("array<string>"),
                                     F.create_map(F.lit("line"), F.col("value"))).alias("row_key"))


def _pay_args():
    return dict(key="order_id", ts="ts", seq="offset",
                start_cond=F.col("status") == "1", end_cond=F.col("status") == "2",
                within=P["pay_within"], payload=["money"])


def order_timeout(spark, sf):
    """J7t: created orders not paid within W."""
    return patterns.timed_out(order_lines(spark, sf), **_pay_args())


def order_paid(spark, sf):
    """Created orders with their first payment within W."""
    return patterns.followed_by(order_lines(spark, sf), **_pay_args())


# ------------------------------------------------------------ stream joins

def _clicks_and_browses(spark, sf):
    clicks = domain.click_log(spark, sf, "click").select(
        F.col("user_id").alias("user_id"), F.col("event_id").alias("click_id"),
        F.col("ts").alias("click_ts"))
    browses = domain.click_log(spark, sf, "view").select(
        F.col("user_id").alias("b_user_id"), F.col("event_id").alias("browse_id"),
        F.col("ts").alias("browse_ts"))
    return clicks, browses


def click_browse_interval(spark, sf):
    """Browses in [click - 6 h, click]."""
    clicks, browses = _clicks_and_browses(spark, sf)
    lower, upper = P["interval_bounds"]
    out = joins.interval_join(clicks, browses, "user_id", "b_user_id", "click_ts",
                              "browse_ts", lower, upper)
    return out.select("user_id", "click_id", "click_ts", "browse_id", "browse_ts")


def click_browse_window(spark, sf):
    """Click and browse pairs in the same tumbling window."""
    clicks, browses = _clicks_and_browses(spark, sf)
    out = joins.window_join(clicks, browses, "user_id", "b_user_id", "click_ts", "browse_ts",
                            P["window_join_width"])
    return out.select("user_id", "click_id", "click_ts", "browse_id", "browse_ts",
                      "window_start", "window_end")


def order_pay_match(spark, sf):
    """J6 + K6: matched / unmatched_order / unmatched_pay."""
    return joins.match_with_timeout(domain.order_events(spark, sf),
                                    domain.pay_events(spark, sf), "order_id", "ts", "ts",
                                    P["match_tolerance"])


def order_pay_message(spark, sf):
    """P14 on J6: the printed lines of the match job (main and side outputs)."""
    out = order_pay_match(spark, sf)
    order_first = F.coalesce(F.col("order_ts") <= F.col("pay_ts"), F.lit(True))
    return out.select("order_id", "outcome",
                      match_message("order_id", "outcome", order_first).alias("message"))


def order_pay_arrival(spark, sf):
    """J6q: the match as its two slots take repeated orders and payments, in arrival order."""
    orders, pays = domain.arrivals(spark, sf)
    return joins.match_in_arrival_order(orders, pays, "order_id", "ts", "ts", "offset", P["match_tolerance"],
                                        chunk=domain.ARRIVALS_A_DAY)


def area_paths(spark, sf):
    """J2 at any depth: the way from the root to every node of a five-level tree."""
    found = dims.ancestors(domain.deep_tree(spark, sf)).where("not cyclic")
    return found.select("id", "depth", "root",
                        F.array_join(F.transform("path", lambda p: p["name"]), "/").alias("path"))


# ------------------------------------------------------------ user-defined aggregates

def user_city_orders(spark, sf):
    """Sum and count per city through the aggregate interface."""
    orders = dims.lookup(domain.trade_orders(spark, sf), area_dimension(spark, sf), "area_id", "areaid")
    orders = orders.withColumn("cents", (F.col("total_money").cast(MONEY) * 100).cast("bigint"))
    out = aggregates.aggregate(orders, ["city", "province"], ["cents"], aggregates.SumAndCount(), "t")
    return out.select("city", "province", F.col("t.total").alias("total_money"), F.col("t.n").alias("order_count"))


def user_ad_clicks(spark, sf):
    """Clicks per product and pane through the interface, sliding windows over the panes."""
    width, slide = P["ad_window"]
    clicks = ad_clicks(spark, sf).withColumn("pane", F.window("ts", duration.text(slide)).start)
    panes = aggregates.aggregate(clicks, ["product_id", "pane"], [], aggregates.Count(), "clicks")
    return _with_end(windows.sliding_aggregate(
        panes, "pane", ["product_id"], {"click_count": ("sum", "clicks")}, width, slide))


def user_blacklist(spark, sf):
    """Clicks per user, product and window through the interface."""
    clicks = ad_clicks(spark, sf).withColumn("w", F.window("ts", duration.text(P["blacklist_window"])))
    clicks = clicks.select("uid", "product_id", F.col("w.start").alias("window_start"),
                           F.col("w.end").alias("window_end"))
    keys = ["uid", "product_id", "window_start", "window_end"]
    out = windows.at_least(aggregates.aggregate(clicks, keys, [], aggregates.Count(), "click_count"),
                           "click_count", P["blacklist_threshold"])
    return out.select(*keys, format_ts("window_end").alias("end_time"), "click_count")


def user_channel_users(spark, sf):
    """Distinct users per channel and window; the sets are dealt over the users."""
    ch = channel_events(spark, sf).withColumn("w", F.window("ts", duration.text(P["channel_window"])))
    ch = ch.select("channel", "uid", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
    return aggregates.spread(ch, ["channel", "window_start", "window_end"], "uid", aggregates.DistinctCount(),
                             "user_count")


# ------------------------------------------------------------ change log and stores

def changelog_rows(spark, sf):
    """One row per changed row of the orders table."""
    ch = parse.filter_table(order_changes(spark, sf), domain.CHANGE_TABLE)
    return ch.select("row_key", "database", "table", "type", "es", "change_id", "pos",
                     F.col("row")["o_orderstatus"].alias("o_orderstatus"),
                     F.col("row")["o_totalprice"].try_cast("double").alias("o_totalprice"))


def typed_state(state: DataFrame) -> DataFrame:
    """State rows of all tables, the orders' cells typed."""
    return parse.decode_row(state, ORDER_FIELDS, keep=["table", "row_key", "es"])


def changelog_state(spark, sf):
    """K1: the keyed state after the whole change log (row level), every table apart."""
    return typed_state(cl.row_state(order_changes(spark, sf)))


def changelog_partial(spark, sf):
    """The state with column-level puts: a message's missing cells stay."""
    return typed_state(cl.cell_state(order_changes(spark, sf)))


def typed_orders(spark, sf):
    """Inserted order rows decoded from text cells to typed columns."""
    ch = parse.filter_table(order_changes(spark, sf), domain.CHANGE_TABLE)
    return parse.decode_row(ch.where(F.col("type") == "INSERT"), ORDER_FIELDS, keep=["row_key"])


def _dimension_store(spark, sf):
    """The dimension as the keyed store holds it (K2): text cells, key = first field.

    An earlier write left every other area under another name, which the current
    dimension overwrites, and retired areas that it does not touch.
    """
    dim = area_dimension(spark, sf)

    def rows(areas: DataFrame, seq: int) -> DataFrame:
        return cl.as_text_row(areas, "areaid", AREA_DIMENSION_COLUMNS).withColumn("_seq", F.lit(seq))

    renamed = dim.where(F.col("areaid") % 20 == 3).withColumn("aname", F.lit("renamed"))
    retired = (dim.where(F.col("areaid") % 100 == 3).withColumn("aname", F.lit("retired"))
               .withColumn("areaid", -F.col("areaid")))
    return cl.upsert_rows(rows(renamed.unionByName(retired), 0), rows(dim, 1),
                          "row_key", "_seq").drop("_seq")


def change_store(spark: SparkSession, root: str, state=cl.cell_state) -> KeyedLog:
    """The keyed store of ingested tables: a folder per table, state by ``state``."""
    return KeyedLog(spark, root, cl.CHANGE_SCHEMA, state, partition_by=("database", "table"))


def city_order_total_stored(spark, sf):
    """Feature 1 end to end as the warehouse runs it: the change log is ingested into
    its keyed store and the dimension into another (K1b, K2); both are read back as
    JSON (S3) and decoded with coercion (P7), then joined and totalled (J1, A1).
    Deleted orders are gone and updated ones carry their new cells.
    """
    folder = run_folder(spark, "city_order_total_stored")
    store = change_store(spark, f"{folder}/changes")
    store.append(cl.supported(order_changes(spark, sf)))
    _dimension_store(spark, sf).write.parquet(f"{folder}/dimension")

    dim_json = cl.scan_as_json(spark.read.parquet(f"{folder}/dimension"))
    dim = dim_json.select(F.from_json("json", "map<string,string>").alias("row"))
    dim = parse.decode_row(dim, {"areaid": ("areaid", "bigint"), "city": ("city", "string"),
                                 "province": ("province", "string")})
    kept = parse.filter_table(store.read(), domain.CHANGE_TABLE)
    orders_json = kept.select("row_key", F.to_json("row").alias("json"))
    return city_totals_of(orders_json.select(F.from_json("json", "map<string,string>").alias("row")),
                          dim, "o_custkey", "o_totalprice")


def city_totals_of(kept: DataFrame, dim: DataFrame, customer: str, money: str) -> DataFrame:
    """Totals per city of stored orders (``row``: cells as text), per area first."""
    orders = parse.decode_row(kept, {"cust": (customer, "bigint"), "total_money": (money, "double")})
    per_area = (orders.groupBy((F.col("cust") * 10 + domain.LEVEL_AREA).alias("area_id"))
                .agg(F.sum(F.col("total_money").cast(MONEY)).alias("_m"),
                     F.count(F.lit(1)).alias("_n")))
    joined = dims.lookup(per_area, dim, "area_id", "areaid")
    return joined.groupBy("city", "province").agg(
        F.sum("_m").cast("double").alias("total_money"), F.sum("_n").alias("order_count"))


ORDER_IMAGE = {"cust": ("o_custkey", "bigint"), "total_money": ("o_totalprice", "double")}


def signed_city_orders(spark, sf):
    """Signed orders with their city: every change of the orders table takes back what the order
    was and adds what it is (P11), passed through the area join (J1)."""
    changes = parse.filter_table(order_changes(spark, sf), domain.CHANGE_TABLE)
    signed = retract.signed_rows(retract.row_images(changes, ORDER_IMAGE))
    signed = signed.withColumn("area_id", F.col("cust") * 10 + domain.LEVEL_AREA)
    return dims.lookup(signed, area_dimension(spark, sf).select("areaid", "city", "province"),
                       "area_id", "areaid")


def city_order_total_maintained(spark, sf):
    """Feature 1 by incremental view maintenance: the sum of all signed rows is the total
    over the stored orders (``city_order_total_stored``)."""
    return retract.totals(signed_city_orders(spark, sf), ["city", "province"], "total_money")


def city_order_retractions(spark, sf):
    """The add-retract stream of feature 1. Every change of an order takes back its
    city's old totals and adds the new ones."""
    return retract.changelog_of_totals(signed_city_orders(spark, sf), ["city", "province"], "total_money",
                                       ["es", "change_id", "pos", "row_key"])


def row_upsert(spark, sf):
    """K2 + P15: the dimension written as text rows keyed by its first field."""
    return _dimension_store(spark, sf)


def _stored_dimension(spark, sf, name):
    """The dimension as K2 has written it, scanned in key order."""
    path = run_folder(spark, name)
    write_keyed(_dimension_store(spark, sf), path)
    return scan_keyed(spark, path)


def row_as_json(spark, sf):
    """S3: the keyed store scanned as (row_key, JSON of cells)."""
    return cl.scan_as_json(_stored_dimension(spark, sf, "row_as_json"))


def row_as_dashed(spark, sf):
    """The keyed store scanned as (row_key, cells joined by '-')."""
    return cl.scan_as_dashed(_stored_dimension(spark, sf, "row_as_dashed"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "city_order_total": city_order_total,
    "city_order_running": city_order_running,
    "area_flatten": area_flatten,
    "order_area_lookup": order_area_lookup,
    "order_area_missing": order_area_missing,
    "city_order_sliding": city_order_sliding,
    "city_serving_state": city_serving_state,
    "ad_events": ad_events,
    "ad_click_sliding": ad_click_sliding,
    "ad_click_sliding_panes": ad_click_sliding_panes,
    "blacklist_tumbling": blacklist_tumbling,
    "blacklist_repeat_skip": blacklist_repeat_skip,
    "blacklist_repeat_all": blacklist_repeat_all,
    "channel_events": channel_events,
    "channel_users": channel_users,
    "channel_message": channel_message_lines,
    "csv_orders": csv_orders,
    "event_scalars": event_scalars,
    "order_timeout": order_timeout,
    "order_paid": order_paid,
    "click_browse_interval": click_browse_interval,
    "click_browse_window": click_browse_window,
    "order_pay_match": order_pay_match,
    "order_pay_message": order_pay_message,
    "changelog_rows": changelog_rows,
    "changelog_state": changelog_state,
    "changelog_partial": changelog_partial,
    "typed_orders": typed_orders,
    "row_upsert": row_upsert,
    "row_as_json": row_as_json,
    "row_as_dashed": row_as_dashed,
    "city_order_total_stored": city_order_total_stored,
    "city_order_total_maintained": city_order_total_maintained,
    "city_order_retractions": city_order_retractions,
    "channel_users_sliding": channel_users_sliding,
    "order_pay_arrival": order_pay_arrival,
    "area_paths": area_paths,
    "user_city_orders": user_city_orders,
    "user_ad_clicks": user_ad_clicks,
    "user_blacklist": user_blacklist,
    "user_channel_users": user_channel_users,
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from .streamed import STREAMED

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    return {name: wrap(fn) for name, fn in {**QUERIES, **STREAMED}.items()}
