"""J7 / J7t against a brute-force model: first end after each start within W."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.operators import patterns

T0 = dt.datetime(2024, 1, 1)


def brute(events, w):
    """events: list of (t, seq, status) of one key -> {start_seq: end_seq or None}."""
    out = {}
    order = sorted(events, key=lambda e: (e[0], e[1]))
    for i, (t, s, st) in enumerate(order):
        if st != "1":
            continue
        nxt = next((e for e in order[i + 1:] if e[2] == "2"), None)
        out[s] = nxt[1] if nxt is not None and nxt[0] - t < w else None
    return out


@pytest.mark.parametrize("seed,sub", [(7, "1 minute"), (8, "3 seconds"), (9, "1 second")])
def test_random(spark, seed, sub):
    rng = np.random.default_rng(seed)
    w = 10
    rows, per_key, seq = [], {}, 0
    for key in ["a", "b", "c"]:
        t, evs = 0, []
        for _ in range(80):
            t += int(rng.choice([0, 0, 1, 3, 7, 12, 25]))
            st = str(rng.choice(["1", "2", "3"]))
            evs.append((t, seq, st))
            rows.append((seq, key, st, T0 + dt.timedelta(seconds=t)))
            seq += 1
        per_key[key] = evs
    df = spark.createDataFrame(rows, "offset long, order_id string, status string, ts timestamp_ntz")
    args = dict(key="order_id", ts="ts", seq="offset", start_cond=F.col("status") == "1",
                end_cond=F.col("status") == "2", within=f"{w} seconds", sub_bucket=sub)
    paid = {r.start_seq: r.end_seq for r in patterns.followed_by(df, **args).collect()}
    late = {r.start_seq for r in patterns.timed_out(df, **args).collect()}
    for key, evs in per_key.items():
        for start, end in brute(evs, w).items():
            if end is None:
                assert start in late and start not in paid
            else:
                assert paid.get(start) == end and start not in late
