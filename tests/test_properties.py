"""Properties: conservation in J6, late rows on a stream, keyed logs, and
session settings restored after starting a stream."""

import datetime as dt
import os

from pyspark.sql import functions as F

from mercato.sources import domain
from mercato.operators import joins
from mercato.streaming import feeds, jobs

from conftest import SF_SMALL


def test_match_outcomes_conserve_rows(spark):
    orders, pays = domain.order_events(spark, SF_SMALL), domain.pay_events(spark, SF_SMALL)
    out = joins.match_with_timeout(orders, pays, "order_id", "ts", "ts", "30 days")
    by = {r.outcome: r.n for r in out.groupBy("outcome").agg(F.count("*").alias("n")).collect()}
    assert by.get("matched", 0) + by.get("unmatched_order", 0) == orders.count()
    assert by.get("matched", 0) + by.get("unmatched_pay", 0) == pays.count()
    # each order id appears once per side it has
    dup = out.where(F.col("outcome") != "unmatched_pay").groupBy("order_id").count()
    assert dup.where(F.col("count") > 1).count() == 0


def _envelope(offset, uid, product, ms):
    return (offset, ('{"lagou_event":[{"name":"ad","json":{"product_id":"%s"},"time":%d}],'
                     '"attr":{"area":"x","uid":"%s","channel":"c"}}') % (product, ms, uid))


def test_late_row_is_dropped(spark, scratch):
    path = os.path.join(scratch, "late")
    base = 1_700_000_000_000
    batches = [
        [_envelope(0, "u", "1", base), _envelope(1, "u", "1", base + 60_000)],
        [_envelope(2, "u", "1", base + 120_000)],
        # older than the watermark (base + 120 s) and than its window's end: late
        [_envelope(3, "u", "1", base + 1_000), _envelope(4, "u", "1", base + 180_000)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, "offset long, value string").coalesce(1) \
            .write.mode("append").json(path)
    src = jobs.json_lines_source(spark, path, max_files_per_trigger=1)
    q = jobs.start(jobs.ad_click_counts(src, "30 seconds", "30 seconds", "0 seconds"),
                   "late_rows", os.path.join(scratch, "ckpt"))
    q.awaitTermination(120)
    got = {r.window_start: r.click_count for r in spark.table("late_rows").collect()}
    first = dt.datetime.fromtimestamp(base // 1000, dt.UTC).replace(tzinfo=None)
    first = first.replace(second=first.second - first.second % 30)
    assert got[first] == 1  # the late click of batch 3 was not added


def test_state_partitions_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with feeds.state_partitions(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_stream_match_keeps_earliest_per_key(spark, scratch):
    from mercato.functions.time import millis_to_ts
    orders = [("order_1", 2000), ("order_1", 3000), ("order_2", 5000)]
    pays = [("order_1", 7500), ("order_2", 8000)]
    for name, rows in (("orders", orders), ("pays", pays)):
        spark.createDataFrame(rows, "order_id string, ms long").coalesce(1) \
            .write.mode("append").json(os.path.join(scratch, name))

    def side(name, ts_col):
        return (spark.readStream.schema("order_id string, ms long")
                .json(os.path.join(scratch, name))
                .select("order_id", millis_to_ts("ms").alias(ts_col)))

    job = jobs.order_pay_outcomes(side("orders", "order_ts"), side("pays", "pay_ts"),
                                  "5 seconds", "0 seconds")
    q = jobs.start(job, "dedup_match", os.path.join(scratch, "ckpt-dedup"))
    q.awaitTermination(120)
    got = sorted((r.order_id, r.outcome) for r in spark.table("dedup_match").collect())
    batch = joins.match_with_timeout(
        spark.createDataFrame(orders, "order_id string, ms long").withColumn("ts", millis_to_ts("ms")),
        spark.createDataFrame(pays, "order_id string, ms long").withColumn("ts", millis_to_ts("ms")),
        "order_id", "ts", "ts", "5 seconds")
    # the earliest order_1 (2000) is 5.5 s before its payment: no match, as in batch;
    # order_2 matches; stream rows are those the final watermark (8 s) has closed
    assert ("order_1", "matched") not in got and ("order_2", "matched") in got
    assert set(got) <= {(r.order_id, r.outcome) for r in batch.collect()}


def test_keyed_log(spark, scratch):
    from mercato.operators import dims
    from mercato.sinks import KeyedLog
    st = KeyedLog(spark, os.path.join(scratch, "store"), "k string, v bigint, at bigint",
                  lambda log: dims.latest_per_key(log, "k", "at"))
    assert st.read().count() == 0  # created on first write
    one = spark.createDataFrame([("a", 1, 5)], "k string, v bigint, at bigint")
    st.append(one)
    st.append(one)                                    # a replayed batch
    st.append(one.selectExpr("k", "9L v", "3L at"))   # a late row
    assert [(r.k, r.v) for r in st.read().collect()] == [("a", 1)]
    write = st.sink(lambda batch, i: batch.selectExpr("'b' k", "v", "cast(%d as bigint) at" % i))
    write(one, 0)       # another query, with a new checkpoint: its batch 0 is not lost
    assert sorted(r.k for r in st.read().collect()) == ["a", "b"]


def test_stateful_pattern_drops_late_rows(spark, scratch):
    from mercato.operators import parse as parse_ops
    from mercato.streaming import stateful
    path = os.path.join(scratch, "late-pattern")
    base = 1_700_000_000_000
    files = [
        [_envelope(0, "u", "1", base), _envelope(1, "u", "1", base + 1_000)],
        [_envelope(2, "u", "1", base + 5_000)],
        # base + 0.5 s arrives when the watermark is at base + 5 s: late, dropped
        # (by Spark before the operator, and by the operator's own guard);
        # kept, it would add the runs (0, 0.5, 1), (0.5, 1, 5) and (0, 0.5, 1, 5)
        [_envelope(3, "u", "1", base + 500), _envelope(4, "u", "1", base + 30_000)],
    ]
    for rows in files:
        spark.createDataFrame(rows, "offset long, value string").coalesce(1) \
            .write.mode("append").json(path)
    src = jobs.json_lines_source(spark, path, max_files_per_trigger=1)
    clicks = jobs.watermarked(parse_ops.parse_ad_clicks(src, keep=["offset"]), "ts", "0 seconds")
    job = stateful.repeated_all_stream(clicks, ["uid", "product_id"], "ts", "offset", 3,
                                       "10 seconds", expand=True)
    q = jobs.start(job, "late_pattern", os.path.join(scratch, "ckpt-lp"))
    q.awaitTermination(120)
    got = [(r.click_count, r.start_ts.second, r.end_ts.second - r.start_ts.second)
           for r in spark.table("late_pattern").collect()]
    assert len(got) == 1 and got[0][0] == 3 and got[0][2] == 5


def test_materialize_uses_the_shared_checkpoint_folder(spark):
    from mercato.session import CHECKPOINT_CONF, materialize
    folder = spark.conf.get(CHECKPOINT_CONF)

    def tree():
        return {os.path.join(d, n) for d, subs, files in os.walk(folder) for n in subs + files}

    before = tree()
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    cut = materialize(df)
    assert sorted(r.x for r in cut.collect()) == [2 * i for i in range(1000)]
    assert tree() - before  # a reliable checkpoint was written under the shared folder
