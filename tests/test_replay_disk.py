"""What a replayed log takes on disk: its feed is compressed, and what only the feed or the run
needed goes when that is done."""

import os
import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from mercato.operators import changelog as cl
from mercato.operators import parse
from mercato.plans import streamed
from mercato.plans.queries import change_store
from mercato.session import checkpoint_dir
from mercato.sources import domain
from mercato.streaming import feeds, jobs
from mercato.streaming.running import RunningTotals


def _there(spark, folder):
    path = os.path.join(checkpoint_dir(spark).removeprefix("file:"), folder)
    return set(os.listdir(path)) if os.path.isdir(path) else set()


def _shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {str(found.apply(i)) for i in range(found.size()) if "shuffle_" in str(found.apply(i))}


def test_the_change_feed_is_small_and_leaves_nothing_behind(spark, scratch):
    """All messages of the log, in a small part of their bytes; neither the table they were derived
    from nor their exchange stays."""
    tables, shuffles = _there(spark, "mercato-tables"), _shuffle_files(spark)
    path = streamed.change_log(spark, SF_SMALL, os.path.join(scratch, "feed"))
    assert _there(spark, "mercato-tables") == tables
    for _ in range(100):
        left = _shuffle_files(spark) - shuffles
        if not left:
            break
        time.sleep(0.1)
    assert not left
    said = spark.read.schema(jobs.VALUE_SCHEMA).json(path).where("offset >= 0")
    want = domain.change_log(spark, SF_SMALL)
    assert said.exceptAll(want).isEmpty() and want.exceptAll(said).isEmpty()
    written = sum(os.stat(os.path.join(path, n)).st_size for n in os.listdir(path) if n.startswith("part-"))
    assert written < said.agg(F.sum(F.octet_length("value"))).first()[0] / 5


def test_messages_are_shaped_in_log_order(spark, scratch, monkeypatch):
    """Short rows are put in order, messages are made of them there; the tail is read like the log."""
    monkeypatch.setattr(feeds, "FILE_ROWS", 100)
    rows = spark.range(950).select((F.col("id") * 7 % 950).alias("at"))
    tail = [spark.createDataFrame([(-1, "end")], "offset long, value string")]
    path = feeds.write_feed(rows, os.path.join(scratch, "feed"), "at", tail=tail, shape=lambda r: r.select(
        F.col("at").alias("offset"), F.repeat(F.lit("x"), 3).alias("value")))
    names = sorted(n for n in os.listdir(path) if n.startswith(("part-", "tail-")))
    got = [[r.offset for r in spark.read.schema(jobs.VALUE_SCHEMA).json(os.path.join(path, n)).collect()] for n in names]
    assert [o for f in got for o in f] == [*range(950), -1] and len(got) == 13


def test_an_ended_replay_keeps_its_result_only(spark):
    runs = _there(spark, "mercato-streams")
    state = streamed.stream_changelog_state(spark, SF_SMALL)
    (run,) = _there(spark, "mercato-streams") - runs
    assert _there(spark, f"mercato-streams/{run}") == {"store"} and state.count() > 0


def test_a_failed_replay_keeps_its_feed(spark, scratch):
    path = feeds.write_feed(spark.range(9).select(F.col("id").alias("offset"), F.lit("x").alias("value")),
                            feeds.feed_path(scratch), F.col("offset"))
    bad = jobs.json_lines_source(spark, path).select(F.raise_error(F.col("value")).cast("string").alias("r"))
    try:
        feeds.drain_to_parquet(bad, scratch)
    except Exception:
        pass
    assert os.path.isdir(path) and os.path.isdir(os.path.join(scratch, "checkpoint"))


def test_a_store_is_written_small(spark, scratch):
    changes = parse.filter_database(parse.parse_changes(domain.change_log(spark, SF_SMALL)))
    store = change_store(spark, scratch)
    store.append(cl.supported(changes))
    names = [n for _, _, found in os.walk(os.path.join(scratch, "log")) for n in found if n.endswith(".parquet")]
    assert names and all(n.endswith(".zstd.parquet") for n in names)
    assert store.log().count() == cl.supported(changes).count()


def _nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def test_puts_send_their_cells_on_without_the_names(spark):
    """What meets a key's deletion carries its row, not the sorted names of the row's columns beside it."""
    changes = parse.parse_changes(spark.createDataFrame([("{}",)], "value string"))
    plan = cl.cell_state(changes)._jdf.queryExecution().optimizedPlan()
    (met,) = [n for n in _nodes(plan) if n.nodeName() == "Window" and "_dead" in n.windowExpressions().toString()]
    sent = {met.child().output().apply(i).name() for i in range(met.child().output().size())}
    assert {"row", "_gone", "row_key"} <= sent and not sent & {"_columns", "type"}


def test_a_replay_keeps_small_state(spark, scratch):
    """State of a replay is compressed well and not kept for versions far back; the session's own stays."""
    asked = ("spark.sql.streaming.stateStore.rocksdb.compression", "spark.sql.streaming.minBatchesToRetain")
    seen, before = [], [spark.conf.get(k, None) for k in asked]
    rows = spark.range(9).select(F.col("id").alias("offset"), F.lit("x").alias("value"))
    feed = feeds.write_feed(rows, feeds.feed_path(scratch), F.col("offset"))
    src = jobs.json_lines_source(spark, feed)
    feeds.replay(spark, scratch, lambda: jobs.start(
        src, "f", os.path.join(scratch, "checkpoint"),
        foreach_batch=lambda b, _: seen.append([b.sparkSession.conf.get(k) for k in asked])))
    assert seen and all(s == ["zstd", "2"] for s in seen)
    assert [spark.conf.get(k, None) for k in asked] == before


def test_running_totals_keep_the_columns_they_need(spark, scratch):
    """A batch is kept while it is worked on, without the columns that it only brings along."""
    totals = RunningTotals(spark, scratch, "city string", "order_id", "money", "ts", "offset")
    rows = spark.range(20).select(
        F.col("id").alias("order_id"), F.lit("c").alias("city"), F.lit(1.5).alias("money"), F.col("id").alias("offset"),
        F.timestamp_seconds(F.col("id")).alias("ts"), F.raise_error(F.lit("asked for")).alias("along"))
    totals.sink(rows, 0)
    assert totals.read().agg(F.max("running_money"), F.max("running_count")).first() == (30.0, 20)
