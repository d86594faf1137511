"""Edge rows (FIXTURES.md section 4) and operator properties."""

import datetime as dt
import json
import os
import random

from pyspark.sql import functions as F

from mercato.functions.time import millis_to_ts
from mercato.operators import changelog as cl
from mercato.operators import dims, joins, parse, patterns, windows

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _env(attr, events):
    return json.dumps({"lagou_event": events, "attr": attr}, ensure_ascii=False)


def test_two_ads_last_wins_and_all_mode(spark):
    value = _env({"area": "a-b", "uid": "u\"1", "channel": "c"}, [
        {"name": "ad", "json": {"product_id": "1"}, "time": 1000},
        {"name": "ad", "json": {"product_id": 2}, "time": 2999},
    ])
    env = spark.createDataFrame([(0, value)], "offset long, value string")
    last = parse.parse_ad_clicks(env).collect()
    assert [(r.product_id, r.uid, r.area) for r in last] == [("2", "u\"1", "a-b")]
    assert last[0].ts == dt.datetime(1970, 1, 1, 0, 0, 2)  # ms cut to seconds
    both = parse.parse_ad_clicks(env, mode="all").collect()
    assert sorted(r.product_id for r in both) == ["1", "2"]


def test_no_ad_envelope_dropped_or_kept(spark):
    value = _env({"area": "x", "uid": "u", "channel": "c"},
                 [{"name": "view", "json": {}, "time": 5}])
    env = spark.createDataFrame([(0, value)], "offset long, value string")
    assert parse.parse_ad_clicks(env).count() == 0
    kept = parse.parse_ad_clicks(env, drop_missing=False).collect()
    assert kept[0].product_id is None and kept[0].ts == dt.datetime(1970, 1, 1)


def test_changelog_edge_types(spark):
    msgs = [
        {"database": "DWSHOW", "table": "t", "type": "INSERT", "es": 1, "id": 1,
         "pkNames": ["k"], "data": [{"k": "1", "a": "x", "b": "y"}]},
        {"database": "dwshow", "table": "t", "type": "insert", "es": 2, "id": 2,  # lower case
         "pkNames": ["k"], "data": [{"k": "2", "a": "lost"}]},
        {"database": "dwshow", "table": "t", "type": "ALTER", "es": 3, "id": 3,  # unsupported
         "pkNames": ["k"], "data": [{"k": "3"}]},
        {"database": "other", "table": "t", "type": "INSERT", "es": 4, "id": 4,  # other db
         "pkNames": ["k"], "data": [{"k": "4"}]},
        {"database": "dwshow", "table": "t", "type": "INSERT", "es": 5, "id": 5,  # no pk
         "pkNames": None, "data": [{"a": "z"}]},
        {"database": "dwshow", "table": "t", "type": "DELETE", "es": 6, "id": 6,
         "pkNames": ["k"], "data": [{"k": "1"}]},
        {"database": "dwshow", "table": "t", "type": "INSERT", "es": 7, "id": 7,  # re-insert
         "pkNames": ["k"], "data": [{"k": "1", "a": "again"}]},
        {"database": "dwshow", "table": "t", "type": "UPDATE", "es": 8, "id": 8,
         "pkNames": ["k"], "data": [{"k": "1", "b": "new", "c": None}]},
    ]
    env = spark.createDataFrame([(i, json.dumps(m)) for i, m in enumerate(msgs)],
                                "offset long, value string")
    changes = parse.filter_database(parse.parse_changes(env))
    keys = {r.row_key for r in changes.collect()}
    assert "2" not in keys and "3" not in keys and "4" not in keys
    assert len([k for k in keys if len(k) == 64]) == 1  # hashed key, not random
    row_state = {r.row_key: dict(r.row) for r in cl.row_state(changes).collect()}
    assert row_state["1"] == {"k": "1", "b": "new", "c": None}
    col_state = {r.row_key: dict(r.row) for r in cl.cell_state(changes).collect()}
    # cells put before the DELETE are gone; later puts merge column by column
    assert col_state["1"] == {"k": "1", "a": "again", "b": "new", "c": None}


def test_changelog_replay_changes_nothing(spark):
    rows = [(i, json.dumps({"database": "dwshow", "table": "t", "type": t, "es": i, "id": i,
                            "pkNames": ["k"], "data": [{"k": str(i % 3), "v": str(i)}]}))
            for i, t in enumerate(["INSERT", "INSERT", "INSERT", "UPDATE", "DELETE"])]
    changes = parse.parse_changes(spark.createDataFrame(rows, "offset long, value string"))
    for state in (cl.row_state, cl.cell_state):
        once, twice = state(changes), state(changes.unionByName(changes))
        assert sorted(map(tuple, once.select("row_key", "es").collect())) == \
            sorted(map(tuple, twice.select("row_key", "es").collect()))


def test_timeout_boundary_is_strict(spark):
    lines = spark.createDataFrame([
        (0, "a,1,2020-01-01 00:00:00,1"), (1, "a,2,2020-01-01 00:15:00,1"),   # exactly 15 min
        (2, "b,1,2020-01-01 00:00:00,1"), (3, "b,2,2020-01-01 00:14:59,1"),
        (4, "c,2,2020-01-01 00:00:00,1"), (5, "c,1,2020-01-01 00:00:00,1"),   # tie, pay first
        (6, "d,1,2020-01-01 00:00:00,1"), (7, "d,2,2020-01-01 00:00:00,1"),   # tie, pay after
    ], "offset long, value string")
    rows = parse.parse_order_lines(lines, keep=["offset"])
    args = dict(key="order_id", ts="ts", seq="offset", start_cond=F.col("status") == "1",
                end_cond=F.col("status") == "2", within="15 minutes")
    assert sorted(r.order_id for r in patterns.timed_out(rows, **args).collect()) == ["a", "c"]


def test_match_tolerance_inclusive_and_dedup(spark):
    o = spark.createDataFrame([("x", 0), ("x", 100), ("y", 0)], "order_id string, ms long") \
        .withColumn("ts", millis_to_ts("ms"))
    p = spark.createDataFrame([("x", 5000), ("y", 5001)], "order_id string, ms long") \
        .withColumn("ts", millis_to_ts("ms"))
    got = sorted((r.order_id, r.outcome) for r in
                 joins.match_with_timeout(o, p, "order_id", "ts", "ts", "5 seconds").collect())
    assert got == [("x", "matched"), ("y", "unmatched_order"), ("y", "unmatched_pay")]


def test_window_end_is_exclusive(spark):
    df = spark.createDataFrame([("p", T0), ("p", T0 + dt.timedelta(seconds=10))],
                               "k string, ts timestamp_ntz")
    out = windows.window_aggregate(df, "ts", ["k"], {"n": ("count", None)}, "10 seconds")
    assert sorted(r.n for r in out.collect()) == [1, 1]


def test_panes_equal_direct_windows(spark):
    rows = [("a" if i % 3 else "b", T0 + dt.timedelta(seconds=7 * i + (i % 5))) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    m = {"n": ("count", None)}
    direct = windows.window_aggregate(df, "ts", ["k"], m, "1 minute", "10 seconds")
    panes = windows.pane_aggregate(df, "ts", ["k"], m, "1 minute", "10 seconds")
    assert direct.exceptAll(panes).count() == 0 and panes.exceptAll(direct).count() == 0


def test_running_totals_equal_plain_window(spark):
    from pyspark.sql import Window
    rows = [("c-1" if i % 4 else (None if i % 8 else "c2"), i * 7 + 1, float(i % 13) + 0.25)
            for i in range(500)]
    df = spark.createDataFrame(rows, "city string, order_id long, money double")
    out = windows.running_totals(df, ["city"], "order_id",
                                 {"m": ("money", "money"), "n": ("count", None)}, chunk=64)
    w = Window.partitionBy("city").orderBy("order_id").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("city", "order_id", "money",
                    F.sum(F.col("money").cast("decimal(18,2)")).over(w).cast("double").alias("m"),
                    F.count(F.lit(1)).over(w).alias("n"))
    assert out.exceptAll(ref.select(out.columns)).count() == 0
    assert out.count() == 500


def test_hierarchy_drops_rows_without_grandparent(spark):
    tree = spark.createDataFrame([(1, "P", 0), (2, "C", 1), (3, "A", 2), (4, "orphan", 99)],
                                 "id long, name string, pid long")
    rows = dims.flatten_hierarchy(tree).collect()
    assert [(r.areaid, r.city, r.province) for r in rows] == [(3, "C", "P")]


def test_repetition_matches_do_not_overlap(spark):
    rows = [(i, "u", "p", "x", T0 + dt.timedelta(seconds=s))
            for i, s in enumerate([0, 1, 2, 3, 4, 5, 6, 30, 31, 32, 100, 101])]
    df = spark.createDataFrame(rows, "offset long, uid string, product_id string, area string, "
                                     "ts timestamp_ntz")
    out = patterns.repeated_skip_past_last(df, ["uid", "product_id"], "ts", "offset", 3,
                                           "10 seconds", payload=["area"], slice_width="2 seconds")
    got = sorted((r.start_ts, r.end_ts) for r in out.collect())
    assert got == [(T0, T0 + dt.timedelta(seconds=2)),
                   (T0 + dt.timedelta(seconds=3), T0 + dt.timedelta(seconds=5)),
                   (T0 + dt.timedelta(seconds=30), T0 + dt.timedelta(seconds=32))]


def _change(i, kind, key, es, table="t", pk=("k",), **cells):
    return (i, json.dumps({"database": "dwshow", "table": table, "type": kind, "es": es, "id": i,
                           "pkNames": list(pk), "data": [{"k": key, **cells}]}))


def test_state_does_not_depend_on_batches_or_arrival(spark, scratch):
    """Shuffled changes appended in random batches give the state of the whole log."""
    from mercato.plans.queries import change_store
    rnd = random.Random(3)
    rows = [_change(i, rnd.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"]), str(rnd.randrange(6)),
                    rnd.randrange(40), rnd.choice(["t", "u"]),
                    **{rnd.choice("ab"): str(i)}) for i in range(120)]
    changes = parse.parse_changes(spark.createDataFrame(rows, "offset long, value string"),
                                  keep=["offset"])

    def rows_of(df):
        return sorted((r.database, r.table, r.row_key, r.es, tuple(sorted(r.row.items())))
                      for r in df.collect())

    for name, state in (("row", cl.row_state), ("cell", cl.cell_state)):
        store = change_store(spark, os.path.join(scratch, name), state)
        order = list(range(len(rows)))
        rnd.shuffle(order)
        for k in range(0, len(order), 40):
            store.append(cl.supported(changes.where(F.col("offset").isin(order[k:k + 40]))))
        assert rows_of(store.read()) == rows_of(state(changes))
        smaller = store.compact(os.path.join(scratch, f"{name}-compact"),
                                cl.latest_changes if state is cl.row_state else lambda log: log)
        assert rows_of(smaller.read()) == rows_of(state(changes))


def test_tables_stay_apart_and_late_changes_lose(spark):
    rows = [_change(1, "INSERT", "1", 100, "orders", v="new"), _change(2, "INSERT", "1", 5, "users", v="u"),
            _change(3, "UPDATE", "1", 1, "orders", v="old"), _change(4, "INSERT", "2", 9, "orders"),
            _change(5, "DELETE", "2", 20, "orders"), _change(6, "UPDATE", "2", 10, "orders", v="late")]
    changes = parse.parse_changes(spark.createDataFrame(rows, "offset long, value string"))
    for state in (cl.row_state, cl.cell_state):
        got = sorted((r.table, r.row_key, r.row.get("v")) for r in state(changes).collect())
        assert got == [("orders", "1", "new"), ("users", "1", "u")]


def test_delete_without_key_is_rejected_and_dropped_types_are_counted(spark):
    from pyspark.sql import Observation
    rows = [_change(1, "INSERT", "1", 1, pk=(), v="a"), _change(2, "DELETE", "1", 2, pk=(), v="a"),
            _change(3, "ALTER", "1", 3), _change(4, "insert", "1", 4)]
    seen = Observation("dropped")
    changes = parse.parse_changes(spark.createDataFrame(rows, "offset long, value string"), observe=seen)
    assert cl.row_state(changes).count() == 1
    assert seen.get["dropped_types"] == 2


def test_null_keys_keep_their_side(spark):
    o = spark.createDataFrame([(None, 0)], "order_id string, ms long").withColumn("ts", millis_to_ts("ms"))
    p = spark.createDataFrame([(None, 0)], "order_id string, ms long").withColumn("ts", millis_to_ts("ms"))
    got = sorted(r.outcome for r in
                 joins.match_with_timeout(o, p, "order_id", "ts", "ts", "5 seconds").collect())
    assert got == ["unmatched_order", "unmatched_pay"]


def test_duplicate_dimension_keys_do_not_double_facts(spark):
    fact = spark.createDataFrame([(1, 10.0), (2, 5.0)], "a long, m double")
    dim = spark.createDataFrame([(1, "old", 0), (1, "new", 1), (2, "x", 0)], "k long, city string, seq int")
    got = sorted((r.a, r.city, r.m) for r in
                 dims.lookup(fact, dim, "a", "k", latest_by="seq").collect())
    assert got == [(1, "new", 10.0), (2, "x", 5.0)]


def test_flatten_with_and_without_levels(spark):
    from conftest import SF_SMALL
    from mercato.sources import domain
    tree = domain.area_tree(spark, SF_SMALL)
    with_levels = dims.flatten_hierarchy(tree, level_col="level")
    assert sorted(map(tuple, with_levels.collect())) == sorted(map(tuple, dims.flatten_hierarchy(tree).collect()))
    plan = with_levels._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("c_custkey") and plan.count("Relation") <= 3  # one scan per level
