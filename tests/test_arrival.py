"""The match of two streams in arrival order, row by row (J6q)."""

import datetime as dt
import random

import pytest

from mercato.operators import joins

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "order_id string, ts timestamp_ntz, offset long"


def machine(events, tol):
    """Slots, timers and the watermark, one arrival after the other. events: (offset, side, key, s)."""
    slots, timers, tops, out = {}, [], [None, None], []

    def flush(key):
        held = slots.pop(key, None)
        if held:
            side, s = held
            out.append((key, s if side == 0 else None, s if side else None,
                        "unmatched_pay" if side else "unmatched_order"))

    for _, side, key, s in sorted(events):
        held = slots.get(key)
        if held and held[0] != side:
            del slots[key]
            out.append((key, *((held[1], s) if side else (s, held[1])), "matched"))
        else:
            slots[key] = (side, s)
            timers.append((s + tol, key))
        tops[side] = s if tops[side] is None else max(tops[side], s)
        if None not in tops:
            reached = min(tops) - 0.001
            for due, k in sorted(t for t in timers if t[0] <= reached):
                flush(k)
            timers = [t for t in timers if t[0] > reached]
    for _, k in sorted(timers):
        flush(k)
    return out


def rows(events, side):
    return [(k, T0 + dt.timedelta(seconds=s), n) for n, x, k, s in events if x == side]


def matched(spark, events, tol, chunk):
    frames = [spark.createDataFrame(rows(events, side), SCHEMA) for side in (0, 1)]
    out = joins.match_in_arrival_order(*frames, "order_id", "ts", "ts", "offset", f"{tol} seconds", chunk)
    return sorted(((r.order_id, *(None if t is None else (t - T0).total_seconds() for t in (r.order_ts, r.pay_ts)),
                    r.outcome) for r in out.collect()), key=str)


@pytest.mark.parametrize("seed,chunk", [(1, 1 << 16), (2, 10), (3, 3), (4, 1)])
def test_slots_by_ranges(spark, seed, chunk):
    """Repeated rows, disorder, a hot key; a key's arrivals cut down to single rows."""
    rnd = random.Random(seed)
    events = []
    for n in range(160):
        key = "hot" if rnd.random() < 0.5 else f"k{rnd.randrange(12)}"
        events.append((n, rnd.randrange(2), key, max(0, n + rnd.randrange(-6, 6))))
    assert matched(spark, events, 5, chunk) == sorted(machine(events, 5), key=str)


def test_golden_and_quirks(spark):
    # unique keys: as the match without quirks
    events = [(1, 0, "order_1", 2), (2, 0, "order_2", 5), (3, 0, "order_3", 6),
              (4, 1, "order_1", 7), (5, 1, "order_2", 8), (6, 1, "order_4", 9)]
    assert [(r[0], r[3]) for r in matched(spark, events, 5, 4)] == [
        ("order_1", "matched"), ("order_2", "matched"), ("order_3", "unmatched_order"),
        ("order_4", "unmatched_pay")]
    # a second order overwrites the first; the first one's timer flushes it early, so the payment
    # in time for it finds nothing
    quirk = [(1, 0, "a", 0), (2, 0, "a", 4), (3, 1, "x", 6), (4, 0, "x", 6), (5, 1, "a", 7)]
    assert ("a", 4.0, None, "unmatched_order") in matched(spark, quirk, 5, 2)
    assert ("a", None, 7.0, "unmatched_pay") in matched(spark, quirk, 5, 2)
    assert matched(spark, [(1, 0, "a", 0)], 5, 2) == [("a", 0.0, None, "unmatched_order")]


def test_rows_without_a_key_or_time(spark):
    orders = spark.createDataFrame([(None, T0, 1), ("a", None, 2)], SCHEMA)
    assert joins.match_in_arrival_order(orders, orders.limit(0), "order_id", "ts", "ts", "offset", "5 seconds").count() == 0


def test_a_key_with_few_arrivals_is_one_range(spark, monkeypatch):
    """Arrivals of a key that lie ranges apart are one group: no round per range. Only keys with
    many arrivals are cut."""
    groups = []
    machine_of = joins.materialize
    monkeypatch.setattr(joins, "materialize", lambda df: groups.append(machine_of(df)) or groups[-1])
    # 40 keys with an arrival in each of eight ranges, sides in turn; one hot key
    events = [(n, n // 40 % 2, f"k{n % 40}", n) for n in range(320)]
    events += [(1000 + n, n % 2, "hot", 1000 + n) for n in range(60)]
    assert matched(spark, events, 500, 50) == sorted(machine(events, 500), key=str)
    started = next(g for g in groups if "_first" in g.columns)
    per_key = {r._k: r.n for r in started.groupBy("_k").agg({"_range": "count"}).withColumnRenamed(
        "count(_range)", "n").collect()}
    assert per_key.pop("hot") == 2 and set(per_key.values()) == {1}
