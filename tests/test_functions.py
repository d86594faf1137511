"""Scalar functions F1-F10, P14, P15."""

import datetime as dt

from pyspark.sql import functions as F

from mercato import functions as fx


def test_scalar_functions(spark):
    df = spark.createDataFrame([("a,b,,c", "1595276738208", "1500", "2020-07-28 00:15:11",
                                 "10468.0", "x1", "DwShow")],
                               "csv string, ms string, secs string, text string, num string, "
                               "bad string, db string")
    r = df.select(
        fx.split_text("csv", ",").alias("parts"),                      # F6
        fx.join_text([F.lit("a"), F.lit(None), F.lit("b")], "_").alias("joined"),  # F7
        fx.millis_to_ts("ms").alias("ts_ms"),                           # F2 (no cut)
        fx.millis_to_ts("ms", truncate_to_seconds=True).alias("ts_s"),  # F2
        fx.format_epoch_seconds(F.lit(1595276738)).alias("txt"),        # F3
        fx.format_ts(fx.seconds_to_ts("secs")).alias("txt2"),           # F5 + F3
        fx.parse_text_ts("text").alias("parsed"),                       # F4
        fx.parse_text_ts("bad").alias("unparsed"),
        fx.to_number("num").alias("n"), fx.to_number("bad").alias("nan"),  # F10
        fx.equals_ignore_case("db", "dwshow").alias("eq"),              # F8
        fx.to_text(F.lit(None).cast("int")).alias("null_text"),         # P15
        fx.channel_message(F.lit("c"), F.lit(3)).alias("msg"),          # P14
        fx.pair_message(F.lit("l"), F.lit("r")).alias("pair"),
        fx.ts_to_millis(fx.millis_to_ts("ms")).alias("back"),
    ).first()
    assert r.parts == ["a", "b", "", "c"]
    assert r.joined == "a_b"
    assert r.ts_ms == dt.datetime(2020, 7, 20, 20, 25, 38, 208000)
    assert r.ts_s == dt.datetime(2020, 7, 20, 20, 25, 38)
    assert r.txt == "2020-07-20 20:25:38"
    assert r.txt2 == "1970-01-01 00:25:00"
    assert r.parsed == dt.datetime(2020, 7, 28, 0, 15, 11) and r.unparsed is None
    assert r.n == 10468.0 and r.nan is None
    assert r.eq is True and r.null_text is None
    assert r.msg == "channel: c, user count: 3" and r.pair == "l ==> r"
    assert r.back == 1595276738208


def test_match_messages(spark):
    df = spark.createDataFrame([("o1", "matched", True), ("o2", "matched", False),
                                ("o3", "unmatched_order", True)],
                               "id string, outcome string, first boolean")
    got = [r.m for r in df.select(fx.match_message("id", "outcome", "first").alias("m")).collect()]
    assert got == ["order id: o1 matched", "order id:o2 matched", "order id: o3 fail to match"]


def test_presets_are_well_formed():
    from mercato.functions import duration
    from mercato.plans import presets
    for preset in (presets.SPEC, presets.LITERAL, presets.LITERAL_AS_RUN, presets.FIXTURE):
        for name in ("order_window", "ad_window"):
            width, slide = (duration.micros(x) for x in preset[name])
            assert width > 0 and slide > 0 and width % slide == 0  # panes need it
        lo, hi = (duration.micros(x) for x in preset["interval_bounds"])
        assert lo <= 0 <= hi or lo <= hi
        for name in ("blacklist_window", "repeat_within", "channel_window", "pay_within",
                     "window_join_width", "match_tolerance", "watermark_delay"):
            assert duration.micros(preset[name]) > 0
    assert duration.micros(presets.SPEC["ad_window"][0]) // \
        duration.micros(presets.SPEC["ad_window"][1]) == 720


def test_approximate_distinct_is_close(spark):
    from conftest import SF_CHECK
    from mercato.operators import windows
    from mercato.plans import queries as q
    ch = q.channel_events(spark, SF_CHECK)
    exact = {(r.channel, r.window_start): r.user_count for r in
             windows.distinct_count(ch, "ts", ["channel"], "uid", "7 days").collect()}
    approx = {(r.channel, r.window_start): r.user_count for r in
              windows.distinct_count(ch, "ts", ["channel"], "uid", "7 days",
                                     approximate=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - v) <= max(2, 0.1 * v) for k, v in exact.items())


def test_typed_decoding_coerces_text(spark):
    """Cells stored as text come back typed; quoted numbers and 0/1 flags work,
    malformed text is NULL instead of failing (the sample trade-order row)."""
    from mercato.operators import parse
    row = spark.createDataFrame(
        [({"areaId": "370203", "isPay": "0", "isRefund": "1", "totalMoney": "10468.0",
           "orderId": "x1", "createTime": "2020-06-28 18:14:01"},)], "row map<string,string>")
    r = parse.decode_row(row, {
        "area_id": ("areaId", "int"), "is_pay": ("isPay", "boolean"),
        "is_refund": ("isRefund", "boolean"), "total_money": ("totalMoney", "double"),
        "order_id": ("orderId", "bigint"), "create_time": ("createTime", "timestamp_ntz"),
        "missing": ("nope", "string")}).first()
    assert (r.area_id, r.is_pay, r.is_refund, r.total_money) == (370203, False, True, 10468.0)
    assert r.order_id is None and r.missing is None
    assert r.create_time == dt.datetime(2020, 6, 28, 18, 14, 1)
