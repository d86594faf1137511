"""The job launcher, run end to end on replayed logs derived from the test tables."""

import os

import pytest
from pyspark.sql import functions as F

from mercato import cli
from mercato.operators import changelog as cl
from mercato.plans import queries as q
from mercato.plans import streamed
from mercato.sources import domain
from mercato.streaming import feeds

from conftest import SF_SMALL
from test_goldens import ORDER_LINES

CITY = ["--table", "orders", "--order-key", "o_orderkey", "--area-key", "o_custkey", "--money-key",
        "o_totalprice", "--time-key", "o_orderdate", "--preset", "fixture"]


def _run(argv):
    query = cli.run(cli.parser().parse_args(argv))
    if query is not None:
        feeds.run_to_end(query)


def _stream(job, path, out, *more):
    _run([job, "--path", path, "--max-files-per-trigger", "1", "--out", out, "--available-now",
          "--watermark-delay", "0 seconds", *more])


def _rows(df, cols=None):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return str(tmp_path_factory.mktemp("cli"))


@pytest.fixture(scope="module")
def dimension(spark, folder):
    """The launcher's dimension store, keyed by customer as the change log is."""
    tree = os.path.join(folder, "tree")
    domain.area_tree(spark, SF_SMALL).write.parquet(tree)
    out = os.path.join(folder, "dim")
    _run(["area-dimension", "--path", tree, "--out", out])
    _run(["area-dimension", "--path", tree, "--out", out])  # rebuilt: nothing doubles
    dim = cli.dimension_store(spark, out).read()
    assert _rows(dim) == _rows(q.area_dimension(spark, SF_SMALL))
    by_customer = os.path.join(folder, "dim-by-customer")
    cli.dimension_store(spark, by_customer).append(
        dim.withColumn("areaid", ((F.col("areaid") - 3) / 10).cast("bigint"))
        .withColumn("at", F.current_timestamp()))
    return by_customer


@pytest.fixture(scope="module")
def changes(spark, folder):
    return streamed.change_log(spark, SF_SMALL, os.path.join(folder, "changes"))


@pytest.fixture(scope="module")
def envelopes(spark, folder):
    return streamed.envelope_log(spark, SF_SMALL, os.path.join(folder, "envelopes"))


def test_city_totals(spark, scratch, dimension, changes):
    out = os.path.join(scratch, "totals")
    _stream("city-totals", changes, out, "--dimension", dimension, *CITY)
    got = streamed.totals_store(spark, out).read()
    cols = ["city", "province", "total_money", "order_count"]
    assert _rows(got, cols) == _rows(q.city_order_total(spark, SF_SMALL), cols)


def test_ingest_and_totals_of_the_kept_orders(spark, scratch, dimension, changes):
    store = os.path.join(scratch, "store")
    _stream("ingest", changes, store)
    got = q.change_store(spark, store, cl.row_state).read().where(F.col("es") < streamed.END_MS)
    cols = ["table", "row_key", "es"]
    assert _rows(got, cols) == _rows(q.changelog_state(spark, SF_SMALL), cols)
    out = os.path.join(scratch, "totals")
    # the store's customers are areas of this dimension only after the rule * 10 + 3
    tree_dim = os.path.join(scratch, "dim")
    cli.dimension_store(spark, tree_dim).append(
        q.area_dimension(spark, SF_SMALL).withColumn("at", F.current_timestamp()))
    _run(["city-totals-stored", "--store", store, "--dimension", tree_dim, "--out", out, *CITY])
    cols = ["city", "province", "total_money", "order_count"]
    assert _rows(streamed.totals_store(spark, out).read(), cols) == \
        _rows(q.city_order_total_stored(spark, SF_SMALL), cols)


def test_city_sliding_and_missing_areas(spark, scratch, dimension, changes):
    out = os.path.join(scratch, "serving")
    _stream("city-sliding", changes, out, "--dimension", dimension, *CITY)
    assert _rows(streamed.serving_store(spark, out).read()) == _rows(q.city_serving_state(spark, SF_SMALL))
    out = os.path.join(scratch, "missing")
    _stream("orders-without-area", changes, out, "--dimension", dimension, *CITY)
    got, want = spark.read.parquet(out), q.order_area_missing(spark, SF_SMALL)
    assert _rows(got, ["order_id"]) == _rows(want, ["order_id"]) and got.count() > 0


def test_city_running(spark, scratch, dimension, changes):
    out = os.path.join(scratch, "running")
    _stream("city-running", changes, out, "--dimension", dimension, *CITY)
    cols = ["city", "province", "order_id", "running_money", "running_count"]
    got = spark.read.parquet(f"{out}/rows")
    assert _rows(got, cols) == _rows(streamed.stream_city_order_running(spark, SF_SMALL), cols)


ENVELOPE_JOBS = [
    ("ad-clicks", q.ad_click_sliding, ["product_id", "window_start", "window_end", "click_count"]),
    ("blacklist", q.blacklist_tumbling, ["uid", "product_id", "window_start", "window_end", "click_count"]),
    ("channels", q.channel_users, ["channel", "window_start", "window_end", "user_count"]),
    ("channel-messages", q.channel_message_lines, ["channel", "window_start", "message"]),
    ("blacklist-pattern", q.blacklist_repeat_skip,
     ["uid", "product_id", "click_count", "area", "start_ts", "end_ts"]),
    ("blacklist-runs", q.blacklist_repeat_all,
     ["uid", "product_id", "click_count", "area", "start_ts", "shortest_start_ts", "end_ts"]),
]


@pytest.mark.parametrize("job,batch,cols", ENVELOPE_JOBS)
def test_envelope_jobs_give_the_batch_rows(spark, scratch, envelopes, job, batch, cols):
    out = os.path.join(scratch, job)
    _stream(job, envelopes, out, "--preset", "fixture")
    got = spark.read.parquet(out)
    assert _rows(got, cols) == _rows(batch(spark, SF_SMALL), cols) and got.count() > 0


def test_order_timeouts(spark, scratch):
    path = os.path.join(scratch, "lines")
    for line in ORDER_LINES:
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(path)
    out = os.path.join(scratch, "timeouts")
    _run(["order-timeouts", "--path", path, "--max-files-per-trigger", "1", "--out", out,
          "--watermark-delay", "500 milliseconds", "--available-now"])
    got = sorted(r.order_id for r in spark.read.parquet(out).collect())
    assert got == ["1001", "8457"]


def test_two_stream_jobs(spark, scratch):
    def log(df, name, order):
        return streamed._timed_log(df, os.path.join(scratch, name), "", order)

    sides = [log(domain.click_log(spark, SF_SMALL, kind), kind, F.col("event_id")) for kind in ("click", "view")]
    for job, batch, cols in (
            ("click-browse-interval", q.click_browse_interval, ["click_id", "browse_id"]),
            ("click-browse-window", q.click_browse_window, ["click_id", "browse_id", "window_start"])):
        out = os.path.join(scratch, job)
        _stream(job, sides[0], out, "--other-path", sides[1], "--preset", "fixture")
        got = spark.read.parquet(out)
        assert _rows(got, cols) == _rows(batch(spark, SF_SMALL), cols) and got.count() > 0
    by_time = F.unix_micros(F.col("ts").cast("timestamp"))
    orders = log(domain.order_events(spark, SF_SMALL), "orders", by_time)
    pays = log(domain.pay_events(spark, SF_SMALL), "pays", by_time)
    out = os.path.join(scratch, "match")
    _stream("order-pay-match", orders, out, "--other-path", pays, "--preset", "fixture")
    cols = ["order_id", "outcome"]
    assert _rows(spark.read.parquet(out), cols) == _rows(q.order_pay_match(spark, SF_SMALL), cols)
