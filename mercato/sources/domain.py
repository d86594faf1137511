"""The shared test tables turned into the warehouse's domain shapes.

The warehouse reads change logs, app event envelopes, an area tree and order
status lines. The test tables hold a TPC-H-like schema plus an ``events``
table, so each shape here is a declarative projection of them; all work grows
with the tables and stays inside Spark.

Rules (not data):

* area tree: region = province, nation = city, customer = area. A node id is
  ``key * 10 + level`` with level 1, 2, 3, so ids never collide between levels
  and need no lookup table; the root level points to parent 0.
* trade orders: one per ``orders`` row; its area is the customer's area node. Every
  97th order names customer -1, whose area does not exist.
* event envelopes: one per ``events`` row. ``click`` is named ``ad``; the ad's
  product is ``props.k % 5``; area is the customer's nation, channel the
  customer's market segment. Every 11th ad envelope holds an older ad before it,
  every 13th envelope an older non-ad event after it.
* order status lines: ``click`` = status 1 (created), ``purchase`` = status 2
  (paid), other types 3, 4, 5; the order id is the user.
* change log: every order is INSERTed at its order date; an order with line
  items is UPDATEd to status F one hour after the later of its order date and
  its last ship date; an order without line items is DELETEd 30 days after its
  order date. Every 5th order with line items is UPDATEd again an hour later by
  a message that carries its key and priority only. Beside these, by key: rows of
  two other tables (one with the same keys, one with composite keys and two rows
  per message), of another database, in types that are not taken, a database name
  in capitals, and DELETEs that name no key.
* deep tree: the area tree with orders below areas and line items below orders (five
  levels); orders of customer -1 hang nowhere.
* arrivals: orders at their order date (every 10th once more two days later) and a payment
  per line item at its ship date; a row arrives up to two days after its time.
* clock: an envelope is processed up to six hours after its event, a change up to four hours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import format_ts, ts_to_millis
from .tables import table

LEVEL_PROVINCE, LEVEL_CITY, LEVEL_AREA = 1, 2, 3
ROOT_PARENT = 0
PRODUCTS = 5
STATUS_BY_EVENT = {"click": "1", "purchase": "2", "view": "3", "signup": "4", "error": "5"}
# Fixed value (must equal the reference's): the database that is ingested.
CHANGE_DATABASE = "dwshow"
CHANGE_TABLE = "orders"
NO_CUSTOMER_EVERY = 97
DAY_MS = 86_400_000
TASK_ROWS = 500_000      # rows of the tables that one task of a derived log joins, about


def node_id(key, level: int):
    return F.col(key).cast("bigint") * 10 + level


def area_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, name, pid, level) nodes of three levels, as the stored area table."""
    region = table(spark, sf_dir, "region").select(
        node_id("r_regionkey", LEVEL_PROVINCE).alias("id"), F.col("r_name").alias("name"),
        F.lit(ROOT_PARENT).cast("bigint").alias("pid"), F.lit(LEVEL_PROVINCE).alias("level"))
    nation = table(spark, sf_dir, "nation").select(
        node_id("n_nationkey", LEVEL_CITY).alias("id"), F.col("n_name").alias("name"),
        node_id("n_regionkey", LEVEL_PROVINCE).alias("pid"), F.lit(LEVEL_CITY).alias("level"))
    customer = table(spark, sf_dir, "customer").select(
        node_id("c_custkey", LEVEL_AREA).alias("id"), F.col("c_name").alias("name"),
        node_id("c_nationkey", LEVEL_CITY).alias("pid"), F.lit(LEVEL_AREA).alias("level"))
    return region.unionByName(nation).unionByName(customer)


def ordering_customer():
    return F.when(F.col("o_orderkey") % NO_CUSTOMER_EVERY == 0, F.lit(-1).cast("bigint")).otherwise(
        F.col("o_custkey").cast("bigint"))


def trade_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade orders keyed by order id, located in an area node."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        (ordering_customer() * 10 + LEVEL_AREA).alias("area_id"),
        ordering_customer().alias("user_id"),
        F.col("o_totalprice").alias("total_money"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("create_time"),
    )


def _customer_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (table(spark, sf_dir, "customer")
            .select("c_custkey", "c_nationkey", "c_mktsegment")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select("c_custkey", F.col("n_name").alias("area"),
                    F.col("c_mktsegment").alias("channel")))


def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(offset, value): one JSON envelope per event, as the event-log topic carries."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "props")
    ev = events.join(_customer_attrs(spark, sf_dir),
                     F.col("user_id") == F.col("c_custkey"), "left")
    is_ad = F.col("event_type") == "click"
    k = F.get_json_object("props", "$.k").cast("bigint")

    def event(name, product, kind, millis):
        payload = F.struct(product.cast("string").alias("product_id"),
                           F.when(is_ad, F.lit("0")).alias("ad_action"), kind.alias("event_type"))
        return F.struct(name.alias("name"), payload.alias("json"), millis.alias("time"))

    at = ts_to_millis("ts")
    common = F.lit("common")
    events = F.array(
        F.when(is_ad & (F.col("event_id") % 11 == 0),
               event(F.lit("ad"), (k + 1) % PRODUCTS, F.lit("ad"), at - 1000)),
        event(F.when(is_ad, F.lit("ad")).otherwise(F.col("event_type")),
              F.when(is_ad, k % PRODUCTS), F.when(is_ad, F.lit("ad")).otherwise(common), at),
        F.when(F.col("event_id") % 13 == 0,
               event(common, F.lit(None).cast("bigint"), common, at - 500)))
    attr = F.struct(
        F.col("area").alias("area"),
        F.col("user_id").cast("string").alias("uid"),
        F.col("channel").alias("channel"),
        F.lit("common").alias("event_type"),
    )
    return ev.select(
        F.col("event_id").alias("offset"),
        F.to_json(F.struct(F.filter(events, lambda e: e.isNotNull()).alias("lagou_event"),
                           attr.alias("attr"))).alias("value"),
    )


def order_status_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(offset, value): CSV lines ``order_id,status,time,money`` as the socket carries."""
    status = F.col("event_type")
    code = F.lit(None).cast("string")
    for name, value in STATUS_BY_EVENT.items():
        code = F.when(status == name, F.lit(value)).otherwise(code)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("offset"),
        F.concat_ws(",", F.col("user_id").cast("string"), code, format_ts("ts"),
                    F.col("value").cast("string")).alias("value"),
    )


def deep_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, name, pid): region, nation, customer, order, line item."""
    orders = table(spark, sf_dir, "orders").select(
        node_id("o_orderkey", 4).alias("id"), F.concat(F.lit("order "), "o_orderkey").alias("name"),
        (ordering_customer() * 10 + LEVEL_AREA).alias("pid"))
    items = table(spark, sf_dir, "lineitem").select(
        ((F.col("l_orderkey").cast("bigint") * 8 + F.col("l_linenumber")) * 10 + 5).alias("id"),
        F.concat(F.lit("item "), "l_linenumber").alias("name"), node_id("l_orderkey", 4).alias("pid"))
    return area_tree(spark, sf_dir).drop("level").unionByName(orders).unionByName(items)


ARRIVALS_A_DAY = 16 * 10**12     # arrival numbers of a day


def arrivals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Order and payment rows (order_id, ts, offset); ``offset`` is the order of arrival."""
    def arriving(df, line):
        day = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / (DAY_MS * 1000))
        day = day + F.pmod(F.col("order_id") * 7 + line, F.lit(3))
        return df.select("order_id", "ts", ((day * 10**12 + F.col("order_id")) * 16 + line).cast("bigint").alias("offset"))

    orders = order_events(spark, sf_dir)
    again = (orders.where(F.col("order_id") % 10 == 0)
             .withColumn("ts", F.col("ts") + F.expr("INTERVAL 2 DAYS")))
    pays = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").cast("timestamp_ntz").alias("ts"), "l_linenumber")
    return (arriving(orders, F.lit(0)).unionByName(arriving(again, F.lit(8))),
            arriving(pays, F.col("l_linenumber")))


def click_log(spark: SparkSession, sf_dir: str, event_type: str = "click") -> DataFrame:
    """(user_id, event_id, ts) of one event type: clicks, or ``view`` for browsing."""
    return (table(spark, sf_dir, "events")
            .where(F.col("event_type") == event_type)
            .select("user_id", "event_id", "ts"))


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, ts): an order is created at its order date."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("ts"))


def pay_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, ts): an order is paid at its first ship date (partial aggregate)."""
    return (table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").alias("order_id"))
            .agg(F.min("l_shipdate").alias("ts")))


def _row(**cells):
    """A row as the log carries it: every cell as text."""
    return F.create_map(*[x for k, v in cells.items() for x in (F.lit(k), v.cast("string"))])


def _order_row():
    return _row(o_orderkey=F.col("o_orderkey"), o_custkey=F.col("o_custkey"), o_orderstatus=F.col("o_orderstatus"),
                o_totalprice=F.col("o_totalprice"), o_orderdate=F.col("o_orderdate"),
                o_orderpriority=F.col("o_orderpriority"))


def change_log(spark: SparkSession, sf_dir: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """(offset, value): change-log JSON envelopes, see the rules above."""
    orders = change_orders(spark, sf_dir, task_rows)
    # numbers and dates as text once per order, for all of its messages
    text = {c: F.col(c).cast("string") for c in ("o_custkey", "o_totalprice", "o_orderdate")}
    return change_messages(change_rows(orders.withColumns(text)))


def change_orders(spark: SparkSession, sf_dir: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """What the change log says of an order, one row each: its cells, when it was ``created`` and
    ``updated`` (milliseconds), and whether it has line items.

    Orders and line items meet in as many tasks as their rows ask for (about ``task_rows`` each, a
    task per core at least), so a task's memory does not follow the tables. Parquet keeps the row counts.
    """
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    tasks = max(spark.sparkContext.defaultParallelism, -(-(orders.count() + items.count()) // task_rows))
    orders = orders.repartition(tasks, "o_orderkey")
    last_ship = (items.select(F.col("l_orderkey").alias("k"), "l_shipdate").repartition(tasks, "k")
                 .groupBy("k").agg(F.max("l_shipdate").alias("last_ship")))
    return (orders.join(last_ship, F.col("o_orderkey") == F.col("k"), "left")
            .select("o_orderkey", ordering_customer().alias("o_custkey"), "o_orderstatus", "o_totalprice", "o_orderdate",
                    "o_orderpriority", ts_to_millis("o_orderdate").alias("created"),
                    (ts_to_millis(F.greatest("o_orderdate", "last_ship")) + 3_600_000).alias("updated"),
                    F.col("last_ship").isNotNull().alias("has_items")))


def _by_seq(cases: dict, otherwise):
    """The value that a message of this number has."""
    out = None
    for number, value in cases.items():
        out = (F if out is None else out).when(F.col("seq") == number, value)
    return out.otherwise(otherwise)


def change_rows(orders: DataFrame) -> DataFrame:
    """One row per message of the log: the order's cells, the number ``seq`` of the message and its
    time ``es``. A row is a fraction of its message, which ``change_messages`` writes.

    One pass over the orders: each names its messages by number, which are then written one by one
    (all of them in one expression would be more generated code than is compiled).
    """
    key, created, updated, has_items = (F.col(c) for c in ("o_orderkey", "created", "updated", "has_items"))
    said = F.array(
        F.lit(1), F.when(has_items, 2).otherwise(3), F.when(has_items & (key % 5 == 0), 4), F.when(key % 4 == 0, 5),
        F.when(key % 89 == 0, 6), F.when(key % 4 == 0, 7), F.when(key % 6 == 0, 8), F.when(key % 10 == 0, 9),
        F.when(key % 10 == 1, 10))
    rows = orders.select("*", F.explode(said).alias("seq")).where("seq is not null")
    es = _by_seq({2: updated, 3: created + 30 * DAY_MS, 4: updated + 3_600_000, 5: created + 1000, 6: created + 1000,
                  7: created + 400 * DAY_MS, 8: updated + DAY_MS, 9: created + 500 * DAY_MS,
                  10: created + 500 * DAY_MS}, created)
    status = _by_seq({2: F.lit("F"), 8: F.lit("Z"), 9: F.lit("L"), 10: F.lit("A")}, F.col("o_orderstatus"))
    return rows.select("o_orderkey", "o_custkey", status.alias("o_orderstatus"), "o_totalprice", "o_orderdate",
                       "o_orderpriority", "seq", es.alias("es"))


def change_messages(rows: DataFrame, *keep: str) -> DataFrame:
    """(offset, value, ``keep``) of change rows."""
    key, seq, es = F.col("o_orderkey"), F.col("seq"), F.col("es")

    def note(line: str, text: str):
        return _row(o_orderkey=key, line=F.lit(line), note=F.lit(text))

    said = _by_seq({4: F.array(_row(o_orderkey=key, o_orderpriority=F.lit("PATCHED"))),
                    5: F.array(note("1", "a"), note("2", "b")),
                    7: F.array(_row(o_orderkey=key, o_orderstatus=F.lit("X")))},
                   F.array(_order_row()))
    names = [F.lit("o_orderkey")]
    value = F.to_json(F.struct(
        said.alias("data"),
        _by_seq({2: F.when(key % 3 == 0, CHANGE_DATABASE.upper()).otherwise(CHANGE_DATABASE),
                 8: F.lit("elsewhere")}, F.lit(CHANGE_DATABASE)).alias("database"),
        es.alias("es"),
        seq.cast("bigint").alias("id"),
        F.lit(False).alias("isDdl"),
        _by_seq({5: F.array(*names, F.lit("line")), 6: F.array().cast("array<string>")}, F.array(*names)).alias("pkNames"),
        _by_seq({5: F.lit("order_notes"), 7: F.lit("order_flags")}, F.lit(CHANGE_TABLE)).alias("table"),
        (es + 500).alias("ts"),
        _by_seq({2: F.lit("UPDATE"), 3: F.lit("DELETE"), 4: F.lit("UPDATE"), 6: F.lit("DELETE"), 9: F.lit("insert"),
                 10: F.lit("ALTER")}, F.lit("INSERT")).alias("type"),
        F.lit("").alias("sql"),
    ))
    return rows.select((key * 16 + seq).alias("offset"), value.alias("value"), *keep)
