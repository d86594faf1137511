"""Golden cases G1-G8 (FIXTURES.md section 1)."""

import datetime as dt

from pyspark.sql import functions as F

from mercato.functions.time import seconds_to_ts, millis_to_ts
from mercato.operators import joins, parse, patterns

# The sample messages of the reference's comments.
AD_ENVELOPE = (
    '{"lagou_event":[{"name":"goods_detail_loading","json":{"entry":"2","goodsid":"0",'
    '"loading_time":"92","action":"3","staytime":"10","showtype":"0"},"time":1595265099584},'
    '{"name":"notification","json":{"action":"1","type":"3"},"time":1595341087663},'
    '{"name":"ad","json":{"duration":"10","ad_action":"0","shop_id":"23","event_type":"ad",'
    '"ad_type":"1","show_style":"0","product_id":"36","place":"placecampaign2_left",'
    '"sort":"1"},"time":1595276738208}],"attr":{"area":"东莞","uid":"2F10092A0",'
    '"app_v":"1.1.0","event_type":"common","device_id":"1FB872-9A1000","os_type":"1.1",'
    '"channel":"广宣","language":"chinese","brand":"iphone-0"}}'
)
CHANGE_ENVELOPE = (
    '{"data":[{"dt":"2020-07-21","cnt":"730766","u_cnt":"585599","device_cnt":"613573",'
    '"ad_action":"1","hour":"0"}],"database":"dwshow","es":1629541975000,"id":22,'
    '"isDdl":false,"mysqlType":{"dt":"varchar(10)","cnt":"bigint(20)","u_cnt":"bigint(20)",'
    '"device_cnt":"bigint(20)","ad_action":"tinyint(4)","hour":"tinyint(4)"},"old":null,'
    '"pkNames":["dt","ad_action","hour"],"sql":"","sqlType":{"dt":12,"cnt":-5,"u_cnt":-5,'
    '"device_cnt":-5,"ad_action":-6,"hour":-6},"table":"ad_show","ts":1629541975548,'
    '"type":"INSERT"}'
)
ORDER_LINES = [
    "9390,1,2020-07-28 00:15:11,295", "5990,1,2020-07-28 00:16:12,165",
    "9390,2,2020-07-28 00:18:11,295", "5990,2,2020-07-28 00:18:12,165",
    "9390,3,2020-07-29 08:06:11,295", "5990,4,2020-07-29 12:21:12,165",
    "8457,1,2020-07-30 00:16:15,132", "5990,5,2020-07-30 18:13:24,165",
    "1001,1,2020-10-20 11:05:15,132", "1001,2,2020-10-20 11:25:15,132",
    "8458,2,2020-10-20 11:00:15,132",
]


def test_g1_interval_join(spark):
    clicks = spark.createDataFrame(
        [("user_1", "1500", "click", "page_1"), ("user_1", "2000", "click", "page_1")],
        "user_id string, event_time string, event_type string, page_id string",
    ).withColumn("click_ts", seconds_to_ts("event_time")).withColumnRenamed("event_time", "ct")
    browses = spark.createDataFrame(
        [("user_1", t, "product_1", "10") for t in ("1000", "1500", "1501", "1502")],
        "b_user string, event_time string, product_id string, product_price string",
    ).withColumn("browse_ts", seconds_to_ts("event_time")).withColumnRenamed("event_time", "bt")
    out = joins.interval_join(clicks, browses, "user_id", "b_user", "click_ts", "browse_ts",
                              "-10 minutes", "0 seconds")
    got = sorted((r.ct, r.bt) for r in out.collect())
    assert got == [("1500", "1000"), ("1500", "1500"), ("2000", "1500"), ("2000", "1501"),
                   ("2000", "1502")]


def test_g2_window_join(spark):
    left = spark.createDataFrame([(1, t) for t in (1999, 2000, 2001)], "k int, lms long") \
        .withColumn("lts", millis_to_ts("lms"))
    right = spark.createDataFrame([(1, t) for t in (1000, 1001, 1002, 1500, 3999, 4000)],
                                  "rk int, rms long").withColumn("rts", millis_to_ts("rms"))
    out = joins.window_join(left, right, "k", "rk", "lts", "rts", "2 seconds")
    got = sorted((r.lms, r.rms) for r in out.collect())
    assert got == [(1999, 1000), (1999, 1001), (1999, 1002), (1999, 1500), (2000, 3999),
                   (2001, 3999)]


def test_g3_match_with_timeout(spark):
    orders = spark.createDataFrame(
        [("order_1", "pay", 2000), ("order_2", "pay", 5000), ("order_3", "pay", 6000)],
        "order_id string, event_type string, ms long").withColumn("ts", millis_to_ts("ms"))
    pays = spark.createDataFrame(
        [("order_1", "weixin", 7000), ("order_2", "weixin", 8000), ("order_4", "weixin", 9000)],
        "order_id string, event_type string, ms long").withColumn("ts", millis_to_ts("ms"))
    out = joins.match_with_timeout(orders, pays, "order_id", "ts", "ts", "5 seconds")
    got = sorted((r.order_id, r.outcome) for r in out.collect())
    assert got == [("order_1", "matched"), ("order_2", "matched"),
                   ("order_3", "unmatched_order"), ("order_4", "unmatched_pay")]


def _order_rows(spark):
    lines = spark.createDataFrame([(i, v) for i, v in enumerate(ORDER_LINES)],
                                  "offset long, value string")
    return parse.parse_order_lines(lines, keep=["offset"])


def test_g4_order_timeout(spark):
    rows = _order_rows(spark)
    args = dict(key="order_id", ts="ts", seq="offset", start_cond=F.col("status") == "1",
                end_cond=F.col("status") == "2", within="15 minutes", payload=["money"])
    timeouts = sorted(r.order_id for r in patterns.timed_out(rows, **args).collect())
    paid = sorted(r.order_id for r in patterns.followed_by(rows, **args).collect())
    assert timeouts == ["1001", "8457"]
    assert paid == ["5990", "9390"]


def _twelve_clicks(spark):
    base = dt.datetime(2020, 7, 20, 20, 25, 30)
    rows = [(i, "东莞", "2F10092A0", "36", base + dt.timedelta(milliseconds=300 * i))
            for i in range(12)]
    return spark.createDataFrame(rows, "offset long, area string, uid string, "
                                       "product_id string, ts timestamp_ntz")


def test_g5_repetition_no_skip(spark):
    out = patterns.repeated_all(_twelve_clicks(spark), ["uid", "product_id"], "ts", "offset",
                                10, "10 seconds", payload=["area"], expand=True)
    rows = out.collect()
    assert sorted(r.click_count for r in rows) == [10, 10, 10, 11, 11, 12]
    assert {r.area for r in rows} == {"东莞"}


def test_g6_repetition_skip_past_last(spark):
    out = patterns.repeated_skip_past_last(_twelve_clicks(spark), ["uid", "product_id"], "ts",
                                           "offset", 10, "10 seconds", payload=["area"])
    rows = out.collect()
    assert [(r.uid, r.product_id, r.click_count, r.area) for r in rows] == [
        ("2F10092A0", "36", 10, "东莞")]


def test_g7_event_envelope(spark):
    env = spark.createDataFrame([(0, AD_ENVELOPE)], "offset long, value string")
    ad = parse.parse_ad_clicks(env).collect()
    assert [(r.area, r.uid, r.product_id, r.ts) for r in ad] == [
        ("东莞", "2F10092A0", "36", dt.datetime(2020, 7, 20, 20, 25, 38))]
    ch = parse.parse_channels(env).collect()
    assert [(r.channel, r.uid) for r in ch] == [("广宣", "2F10092A0")]


def test_g8_change_envelope(spark):
    env = spark.createDataFrame([(0, CHANGE_ENVELOPE)], "offset long, value string")
    rows = parse.parse_changes(env).collect()
    assert len(rows) == 1
    assert rows[0].row_key == "2020-07-21_1_0"
    assert rows[0].table == "ad_show" and rows[0].database == "dwshow"
    assert rows[0].row["cnt"] == "730766"
