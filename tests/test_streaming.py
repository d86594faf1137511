"""Streams: replayed logs give the batch operators' rows; bad rows, late
rows, replays and restarts; state that goes away."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from mercato.operators import changelog as cl
from mercato.operators import parse, patterns, windows
from mercato.plans import streamed
from mercato.plans.queries import change_store
from mercato.sources import domain
from mercato.streaming import feeds, jobs, stateful
from mercato.streaming.running import RunningTotals

from conftest import SF_SMALL
from test_goldens import ORDER_LINES


def _run(spark, df, name, scratch):
    q = jobs.start(df, name, os.path.join(scratch, f"ckpt-{name}"))
    feeds.run_to_end(q)
    return spark.table(name)


def _rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def _files(spark, path, batches, schema="offset long, value string"):
    """One file per batch, in order."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(path)
    return jobs.json_lines_source(spark, path, max_files_per_trigger=1, schema=schema)


def test_feed_is_the_whole_log_in_order(spark, scratch):
    rows = [(i * 7 % 1000, f"v{i}") for i in range(1000)] + [(None, "no order"), (None, "none")]
    df = spark.createDataFrame(rows, "offset long, value string")
    tail = [spark.createDataFrame([(-1, "end")], "offset long, value string")]
    path = feeds.write_feed(df, os.path.join(scratch, "feed"), F.col("offset"), files=5, tail=tail)
    names = sorted(n for n in os.listdir(path) if n.startswith(("part-", "tail-")))
    times = [os.stat(os.path.join(path, n)).st_mtime for n in names]
    assert len(names) > 3 and times == sorted(times) and len(set(times)) == len(times)
    per_file = [[r.offset for r in spark.read.schema(df.schema).json(os.path.join(path, n)).collect()]
                for n in names]
    assert per_file[-1] == [-1] and sum(map(len, per_file)) == len(rows) + 1
    known = [o for f in per_file[:-1] for o in f if o is not None]
    assert known == sorted(known) and len(known) == 1000
    # no range holds much more than its share
    assert max(map(len, per_file)) < 2 * len(rows) / 5


def test_a_larger_log_has_more_files_in_as_many_batches(spark, scratch, monkeypatch):
    """The sort behind a file stays bounded; the tail keeps a micro-batch of its own."""
    monkeypatch.setattr(feeds, "FILE_ROWS", 100)
    df = spark.range(950).select(F.col("id").alias("offset"), F.col("id").cast("string").alias("value"))
    tail = [spark.createDataFrame([(-i, "end")], df.schema) for i in (1, 2)]
    path = feeds.write_feed(df, os.path.join(scratch, "feed"), F.col("offset"), tail=tail)
    per = feeds.batch_files(spark, path)
    names = sorted(n for n in os.listdir(path) if n.startswith(("part-", "tail-")))
    log = [n for n in names if n.startswith("part-")]
    assert per == 3 and len(log) == 12 and len(names) == 14
    sizes = [spark.read.text(os.path.join(path, n)).count() for n in log]
    assert sum(sizes) == 950 and max(sizes) < 200
    batches = []
    feeds.run_to_end(jobs.start(jobs.json_lines_source(spark, path, per), "f", os.path.join(scratch, "ckpt"),
                                foreach_batch=lambda b, _: batches.append([r.offset for r in b.collect()])))
    assert len(batches) == 5 and sorted(batches[-1]) == [-2, -1]
    assert sorted(o for b in batches[:-1] for o in b) == list(range(950))
    assert all(max(a) < min(b) for a, b in zip(batches[:-1], batches[1:-1]))


@pytest.fixture(scope="module")
def envelope_dir(spark, tmp_path_factory):
    return streamed.envelope_log(spark, SF_SMALL, str(tmp_path_factory.mktemp("env") / "feed"))


def test_channel_users_stream_equals_batch(spark, envelope_dir, scratch):
    src = jobs.json_lines_source(spark, envelope_dir, max_files_per_trigger=1)
    got = _run(spark, jobs.channel_users(src, "1 day", "0 seconds"), "channel_stream", scratch)
    ch = parse.parse_channels(domain.event_envelopes(spark, SF_SMALL))
    want = windows.distinct_count(ch, "ts", ["channel"], "uid", "1 day")
    cols = ["channel", "window_start", "window_end", "user_count"]
    assert _rows(got, cols) == _rows(want, cols) and got.count() > 0


def test_a_failing_stream_raises(spark, scratch):
    src = _files(spark, os.path.join(scratch, "in"), [[(0, "x")]])
    bad = src.select(F.raise_error(F.col("value")).alias("r"))
    with pytest.raises(Exception):
        feeds.drain_to_parquet(bad, os.path.join(scratch, "out"))


def test_ingest_into_one_store_twice_loses_nothing(spark, scratch):
    """A second query with a new checkpoint over the same store; a replayed batch."""
    path = streamed.change_log(spark, SF_SMALL, os.path.join(scratch, "feed"))
    store = change_store(spark, os.path.join(scratch, "store"), cl.row_state)
    messages = spark.read.schema(jobs.VALUE_SCHEMA).json(path)
    want = cl.row_state(parse.filter_database(parse.parse_changes(messages)))
    for attempt in ("first", "second"):
        src = jobs.json_lines_source(spark, path, max_files_per_trigger=1)
        changes = parse.filter_database(parse.parse_changes(src))
        feeds.run_to_end(jobs.start(changes, attempt, os.path.join(scratch, attempt),
                                    foreach_batch=store.sink(lambda b, _: cl.supported(b))))
        cols = ["database", "table", "row_key", "es"]
        assert _rows(store.read(), cols) == _rows(want, cols)


def test_order_timeouts_survive_a_malformed_line(spark, scratch):
    """G4 with a line whose time cannot be read, a line without a key, and the end."""
    lines = [*ORDER_LINES[:2], "77,1,not a time,5.0", ",,,", *ORDER_LINES[2:],
             f"0,1,{streamed.END_TEXT},0"]
    src = _files(spark, os.path.join(scratch, "in"), [[(i, x)] for i, x in enumerate(lines)])
    rows = jobs.watermarked(parse.parse_order_lines(src, keep=["offset"]), "ts", "500 milliseconds")
    job = stateful.followed_by_stream(rows, "order_id", "ts", "offset", F.col("status") == "1",
                                      F.col("status") == "2", "15 minutes")
    q = jobs.start(job, "g4", os.path.join(scratch, "ckpt"))
    feeds.run_to_end(q)
    got = spark.table("g4")
    batch = parse.parse_order_lines(spark.createDataFrame(
        list(enumerate(lines[:-1])), "offset long, value string"), keep=["offset"])
    want = patterns.timed_out(batch.where("ts is not null"), "order_id", "ts", "offset",
                              F.col("status") == "1", F.col("status") == "2", "15 minutes")
    assert _rows(got.where("outcome = 'timeout'"), ["order_id"]) == _rows(want, ["order_id"])
    # what had no time was counted, and no key is left in the state
    assert sum(p.observedMetrics["no_ts"].dropped for p in q.recentProgress
               if "no_ts" in p.observedMetrics) == 2
    assert q.recentProgress[-1].stateOperators[0].numRowsTotal == 0


def _ad(offset, uid, ms):
    return (offset, ('{"lagou_event":[{"name":"ad","json":{"product_id":"1"},"time":%d}],'
                     '"attr":{"area":"x","uid":"%s","channel":"c"}}') % (ms, uid))


@pytest.mark.parametrize("kind", ["skip", "all"])
def test_pattern_state_goes_with_time(spark, scratch, kind):
    base = 1_700_000_000_000
    batches = [[_ad(i * 10 + j, f"u{i}-{j % 5}", base + i * 60_000 + j * 500) for j in range(10)]
               for i in range(6)]
    src = _files(spark, os.path.join(scratch, "in"), batches)
    clicks = jobs.watermarked(parse.parse_ad_clicks(src, keep=["offset"]), "ts", "0 seconds")
    op = stateful.repeated_skip_past_last_stream if kind == "skip" else stateful.repeated_all_stream
    q = jobs.start(op(clicks, ["uid", "product_id"], "ts", "offset", 2, "10 seconds"),
                   f"goes_{kind}", os.path.join(scratch, "ckpt"))
    feeds.run_to_end(q)
    kept = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    # not the 30 users of all batches: a key has some rows for its events and timers
    assert max(kept) <= 10 * 8 and kept[-1] <= 5 * 8 and kept[-1] < max(kept)
    assert spark.table(f"goes_{kind}").count() > 0


def test_running_totals_exact_money_nulls_and_replay(spark, scratch):
    rows = [("a", 1, 1.005, 0), ("a", 2, None, 1), ("b", 3, 2.5, 2), ("a", 4, 1.0, 3)]
    schema = "city string, id long, money double, seq long"
    df = spark.createDataFrame(rows, schema).withColumn(
        "ts", F.timestamp_seconds(F.col("seq") + 1_700_000_000))
    totals = RunningTotals(spark, os.path.join(scratch, "t"), "city string", "id", "money", "ts", "seq")
    for batch_id, part in enumerate((df.where("seq < 2"), df.where("seq >= 2"))):
        totals.sink(part, batch_id)
    totals.sink(df.where("seq >= 2"), 1)  # replayed
    got = {r.id: (r.city, r.running_money, r.running_count) for r in totals.read().collect()}
    batch = windows.running_totals(df, ["city"], "seq", {"m": ("money", "money"), "n": ("count", None)})
    assert got == {r.id: (r.city, r.m or 0.0, r.n) for r in batch.collect()}
    assert got[1][1] == 1.01 and got[4] == ("a", 2.01, 3)
    later = RunningTotals(spark, os.path.join(scratch, "t"), "city string", "id", "money", "ts", "seq", run="2")
    later.sink(spark.createDataFrame([("a", 9, 1.0, 9, dt.datetime(2024, 1, 1))],
                                     schema + ", ts timestamp"), 0)
    assert {r.id: r.running_money for r in later.read().collect()}[9] == 3.01


def test_running_rows_repeat_as_they_came(spark, scratch):
    """Repeated identifiers, rows without one, NULL keys; snapshots every two batches, replays."""
    rows = [("a", 1, 1.0, 0), ("a", None, 2.0, 1), ("a", None, 3.0, 2), (None, 1, 4.0, 3), ("a", 1, 1.0, 4),
            ("b", 5, None, 5), (None, None, 6.0, 6), ("a", 1, 1.0, 7)]
    df = spark.createDataFrame(rows, "city string, id long, money double, seq long").withColumn(
        "ts", F.timestamp_seconds(F.col("seq") + 1_700_000_000))
    totals = RunningTotals(spark, os.path.join(scratch, "t"), "city string", "id", "money", "ts", "seq", every=2)
    for batch_id in range(8):
        part = df.where(F.col("seq") == batch_id)
        totals.sink(part, batch_id)
        if batch_id % 3 == 0:
            totals.sink(part, batch_id)
    got = sorted(((r.city, r.id, r.running_money, r.running_count) for r in totals.read().collect()), key=str)
    want, sums = [], {}
    for city, id_, money, _ in rows:
        m, n = sums.get(city, (0.0, 0))
        sums[city] = (m + (money or 0.0), n + 1)
        want.append((city, id_, *sums[city]))
    assert got == sorted(want, key=str)
    assert len(os.listdir(os.path.join(scratch, "t", "totals"))) == 3
    assert {r.city: (float(r.money or 0), r.n) for r in totals.increments.read().collect()} == sums


def test_processing_time_windows(spark, scratch):
    """W2 with the machine's clock: every row falls in the window of its arrival."""
    src = _files(spark, os.path.join(scratch, "in"), [[_ad(i, "u", 1_700_000_000_000)] for i in range(3)])
    clicks = jobs.by_processing_time(parse.parse_ad_clicks(src), "ts")
    out = windows.window_aggregate(clicks, "ts", ["product_id"], {"n": ("count", None)}, "1 hour")
    q = jobs.start(out, "proc", os.path.join(scratch, "ckpt"), output_mode="complete")
    feeds.run_to_end(q)
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    got = spark.table("proc").collect()
    assert sum(r.n for r in got) == 3
    assert all(abs(r.window_end.replace(tzinfo=None) - now) < dt.timedelta(hours=2) for r in got)


def test_processing_time_windows_follow_a_fed_clock(spark, scratch):
    """A window closes when the clock passes its end, whatever the events' own times."""
    def row(i, at):
        return (*_ad(i, f"u{i}", 1_700_000_000_000 - i), f"2024-01-01 00:{at}:00")
    src = _files(spark, os.path.join(scratch, "in"), [[row(0, "01"), row(1, "02")], [row(2, "11")], [row(3, "12")],
                                                      [row(4, "35")]], "offset long, value string, arrived string")
    job = jobs.channel_users_processing(src, "10 minutes", "arrived")
    out = feeds.drain_to_parquet(job, os.path.join(scratch, "run"))
    got = sorted((r.window_start.minute, r.user_count) for r in out.collect())
    assert got == [(0, 2), (10, 2)]          # the window of minute 35 is still open


def test_outputs_are_committed_together(spark, scratch):
    """K6: a main and a side output of one stream; files of a batch that never committed are not
    read, and the batch is written once when it runs again."""
    rows = [[(i, "paid" if i % 3 else "timeout")] for i in range(6)]
    src = _files(spark, os.path.join(scratch, "in"), rows, "n long, outcome string")
    outputs = feeds.drain_to_outputs(src, os.path.join(scratch, "out"))
    assert sorted(r.n for r in outputs.read("paid").collect()) == [1, 2, 4, 5]
    assert sorted(r.n for r in outputs.read("timeout").collect()) == [0, 3]
    # what a failed batch left in one output: a file beside the log of commits
    lost = os.path.join(scratch, "lost")
    spark.createDataFrame([(99,)], "n long").coalesce(1).write.parquet(lost)
    name = next(f for f in os.listdir(lost) if f.startswith("part-"))
    with open(os.path.join(lost, name), "rb") as f, \
            open(os.path.join(scratch, "out", "data", "outcome=timeout", name), "wb") as to:
        to.write(f.read())
    assert sorted(r.n for r in outputs.read("timeout").collect()) == [0, 3]
    spark.createDataFrame([(7, "timeout")], "n long, outcome string").coalesce(1).write.mode("append").json(
        os.path.join(scratch, "in"))
    feeds.drain_to_outputs(src, os.path.join(scratch, "out"))
    assert sorted(r.n for r in outputs.read("timeout").collect()) == [0, 3, 7]
    assert outputs.read("paid").columns == ["n"] and outputs.read().count() == 7


def test_maintained_totals_take_changes_in_any_order(spark, scratch):
    """Late and repeated changes; the signed rows of all batches sum to the log's state."""
    from mercato.operators import retract
    from mercato.streaming.maintained import MaintainedTotals, signed_rows_stream
    from test_retract import FIELDS, SCHEMA, random_log

    log = [r for r in random_log(8, changes=120)]
    log += log[:20]
    batches = [log[i::4] for i in range(4)]
    for b in batches:
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").json(os.path.join(scratch, "in"))
    src = jobs.json_lines_source(spark, os.path.join(scratch, "in"), 1, SCHEMA)
    totals = MaintainedTotals(spark, os.path.join(scratch, "t"), "cust bigint", "money", every=2)
    feeds.run_to_end(jobs.start(signed_rows_stream(src, FIELDS), "m", os.path.join(scratch, "ckpt"),
                                foreach_batch=totals.sink))
    totals.sink(spark.createDataFrame([], "cust bigint, money double, sign int"), 50)
    want = retract.totals(retract.signed_rows(retract.row_images(
        spark.createDataFrame(log, SCHEMA).dropDuplicates(["table", "row_key", "es", "change_id"]), FIELDS)),
        ["cust"], "money")
    assert {r.cust: (r.total_money, r.order_count) for r in totals.read().collect()} == {
        r.cust: (r.total_money or 0.0, r.order_count) for r in want.collect()}


def test_two_slots_on_a_stream(spark, scratch):
    """J6q, an order and a payment per micro-batch: a repeated order is lost, and the timer of the
    first, which is not taken back, flushes the second early; its payment finds nothing."""
    from mercato.operators import joins

    def at(s):
        return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)

    orders = [("a", 0), ("a", 4), ("z", 6), ("w", 6), ("v", 6)]
    pays = [("y", 0), ("y", 6), ("x", 6), ("u", 6), ("a", 7)]
    schema = "order_id string, ts timestamp_ntz, offset long"
    frames = [spark.createDataFrame([(k, at(s), 2 * i + n) for i, (k, s) in enumerate(rows)], schema)
              for n, rows in enumerate((orders, pays))]
    batch = joins.match_in_arrival_order(*frames, "order_id", "ts", "ts", "offset", "5 seconds")

    def side(rows, n, ts):
        path = os.path.join(scratch, ts)
        for i, (k, s) in enumerate([*rows, ("end", 9999)]):
            spark.createDataFrame([(k, str(at(s)), 2 * i + n)], "order_id string, ts string, offset long").coalesce(1) \
                .write.mode("append").json(path)
        return (spark.readStream.schema("order_id string, ts string, offset long")
                .option("maxFilesPerTrigger", 1).json(path)
                .select("order_id", F.col("ts").cast("timestamp_ntz").alias(ts), "offset"))

    job = jobs.order_pay_arrivals(side(orders, 0, "order_ts"), side(pays, 1, "pay_ts"), "5 seconds", "0 seconds")
    got = feeds.drain_to_parquet(job, os.path.join(scratch, "run"))
    columns = ["order_id", "order_ts", "pay_ts", "outcome"]
    want = [("a", None, at(7), "unmatched_pay"), ("a", at(4), None, "unmatched_order")]
    for found in (batch, got):
        assert _rows(found.where("order_id = 'a'"), columns) == sorted(want, key=str)


@pytest.mark.parametrize("split", [1, 2])
def test_starts_and_ends_of_one_millisecond(spark, scratch, split):
    """J7, J7t: several creations of an order that time out in the same millisecond, in one micro-batch or
    in two, and one that an end resolves."""
    at = "2024-01-01 00:00:00"
    lines = [f"7,1,{at},1.0", f"7,1,{at},2.0", f"8,1,{at},3.0", f"7,1,{at},4.0", f"8,1,{at},5.0",
             "8,2,2024-01-01 00:05:00,6.0", f"0,1,{streamed.END_TEXT},0"]
    numbered = list(enumerate(lines))
    batches = [numbered] if split == 1 else [numbered[:3], numbered[3:5], numbered[5:]]
    src = _files(spark, os.path.join(scratch, "in"), batches)
    rows = jobs.watermarked(parse.parse_order_lines(src, keep=["offset"]), "ts", "0 seconds")
    args = ("order_id", "ts", "offset", F.col("status") == "1", F.col("status") == "2", "15 minutes")
    name = f"one_ms_{split}"
    feeds.run_to_end(jobs.start(stateful.followed_by_stream(rows, *args), name, os.path.join(scratch, "ckpt")))
    got = {(r.order_id, r.start_seq, r.outcome) for r in spark.table(name).collect()}
    assert got == {("7", 0, "timeout"), ("7", 1, "timeout"), ("7", 3, "timeout"), ("8", 2, "paid"), ("8", 4, "paid")}


def _spread(spark, scratch, name, hours):
    """3000 keys in four micro-batches, a row each at ``hours`` apart, and the end."""
    base = 1_700_000_000
    log = spark.range(12_000).select(
        (F.col("id") % 3000).alias("order_id"),
        F.date_format(F.timestamp_seconds(base + F.floor(F.col("id") / 3000) * 3600 * hours), "yyyy-MM-dd HH:mm:ss")
        .alias("ts"))
    path = os.path.join(scratch, name)
    end = spark.range(1).select(F.lit(-1).cast("bigint").alias("order_id"), F.lit(streamed.END_TEXT).alias("ts"))
    feeds.write_feed(log, path, F.col("ts"), 4, tail=[end])
    return (jobs.json_lines_source(spark, path, 1, "order_id bigint, ts string")
            .select("order_id", F.col("ts").cast("timestamp_ntz").alias("at")))


def test_state_of_many_keys_is_kept_by_bucket(spark, scratch):
    """3000 keys are asked for in buckets, not one by one; a match leaves once, later rows of a side
    and keys that are out of reach leave nothing behind."""
    orders, pays = (_spread(spark, scratch, n, 1) for n in ("orders", "pays"))
    job = jobs.order_pay_outcomes(orders.withColumnRenamed("at", "order_ts"), pays.withColumnRenamed("at", "pay_ts"),
                                  "10 hours", "0 seconds")
    q = jobs.start(job, "by_bucket", os.path.join(scratch, "ckpt"))
    feeds.run_to_end(q)
    got = spark.table("by_bucket")
    assert got.count() == 3000 and got.where("outcome = 'matched' AND order_ts = pay_ts").count() == 3000
    kept = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    assert 0 < max(kept) < 2800 and kept[-1] == 0


@pytest.mark.parametrize("kind", ["skip", "all"])
def test_events_of_one_millisecond_in_two_batches(spark, scratch, kind):
    """J8, J8n: events that wait under the same millisecond, brought by different micro-batches."""
    base = 1_700_000_000_000
    batches = [[_ad(0, "u", base), _ad(1, "u", base)], [_ad(2, "u", base), _ad(3, "v", base)],
               [_ad(4, "u", base + 1_000), _ad(5, "w", base + 60_000)], [_ad(6, "w", base + 120_000)]]
    src = _files(spark, os.path.join(scratch, "in"), batches)
    clicks = jobs.watermarked(parse.parse_ad_clicks(src, keep=["offset"]), "ts", "0 seconds")
    op = stateful.repeated_skip_past_last_stream if kind == "skip" else stateful.repeated_all_stream
    feeds.run_to_end(jobs.start(op(clicks, ["uid", "product_id"], "ts", "offset", 3, "10 seconds"),
                                f"same_ms_{kind}", os.path.join(scratch, "ckpt")))
    got = sorted((r.uid, r.click_count) for r in spark.table(f"same_ms_{kind}").collect())
    assert got == ([("u", 3)] if kind == "skip" else [("u", 3), ("u", 4)])


def test_maintained_rows_are_one_value_each(spark, scratch):
    """A row's cells are one value of its bucket's state, not an entry each; what a later change
    and a deletion take back is what the row was."""
    from mercato.streaming.maintained import MaintainedTotals, signed_rows_stream
    from test_retract import FIELDS, SCHEMA

    cells = [cell for cell, _ in FIELDS.values()]
    changes = spark.range(6000).select(
        F.lit("db").alias("database"), F.lit("t").alias("table"), (F.col("id") % 2000).cast("string").alias("row_key"),
        F.when((F.col("id") >= 4000) & (F.col("id") % 2 == 0), "DELETE").otherwise("INSERT").alias("type"),
        F.col("id").alias("es"), F.lit(0).cast("bigint").alias("change_id"), F.lit(0).alias("pos"),
        F.create_map(*[x for c in cells for x in (F.lit(c), F.lit("5"))]).alias("row"))
    path = os.path.join(scratch, "in")
    names = [f.strip().split()[0] for f in spark.createDataFrame([], SCHEMA).columns]
    feeds.write_feed(changes.select(*names), path, F.col("es"), 3)
    totals = MaintainedTotals(spark, os.path.join(scratch, "t"), "cust bigint", "money")
    q = jobs.start(signed_rows_stream(jobs.json_lines_source(spark, path, 1, SCHEMA), FIELDS), "one_value",
                   os.path.join(scratch, "ckpt"), foreach_batch=totals.sink)
    feeds.run_to_end(q)
    assert [(r.cust, r.total_money, r.order_count) for r in totals.read().collect()] == [(5, 5000.0, 1000)]
    kept = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    assert 0 < max(kept) <= 2000
