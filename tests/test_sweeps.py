"""Wider randomized sweeps of the pattern operators against brute-force models.

Three configurations each by default, 20 with ``MERCATO_SWEEP=1``; NULL keys included.
"""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.operators import patterns
from test_followed_by_random import brute as brute_follow
from test_repetition_random import T0, brute as brute_repeat

SEEDS = 20 if os.environ.get("MERCATO_SWEEP") == "1" else 3


@pytest.mark.parametrize("seed", range(20, 20 + SEEDS))
def test_repetition_sweep(spark, seed):
    rng = np.random.default_rng(seed)
    k, factor = int(rng.integers(2, 6)), int(rng.integers(1, 4))
    chunk, w = int(rng.choice([1, 2, 3, 7, 1 << 20])), int(rng.choice([5, 10, 20]))
    rows, per_key, seq = [], {}, 0
    for key in ["a", "b", None, "d"]:
        t, evs = 0, []
        for _ in range(int(rng.integers(20, 90))):
            t += int(rng.choice([0, 0, 1, 2, 3, 9, 15, 40]))
            evs.append((t, seq))
            rows.append((seq, key, "p", T0 + dt.timedelta(seconds=t)))
            seq += 1
        per_key[key] = evs
    df = spark.createDataFrame(rows, "offset long, uid string, product_id string, ts timestamp_ntz")
    got_all = patterns.repeated_all(df, ["uid", "product_id"], "ts", "offset", k,
                                    f"{w} seconds", slice_width=f"{factor} seconds",
                                    expand=True).collect()
    got_skip = patterns.repeated_skip_past_last(df, ["uid", "product_id"], "ts", "offset", k,
                                                f"{w} seconds", slice_width=f"{factor} seconds",
                                                chunk_rows=chunk).collect()
    for key, evs in per_key.items():
        exp_all, exp_skip = brute_repeat(evs, k, w)

        def conv(rs):
            return sorted((r.click_count, int((r.start_ts - T0).total_seconds()),
                           int((r.end_ts - T0).total_seconds())) for r in rs if r.uid == key)
        assert conv(got_all) == exp_all and conv(got_skip) == exp_skip, key


@pytest.mark.parametrize("seed", range(40, 40 + SEEDS))
def test_followed_by_sweep(spark, seed):
    rng = np.random.default_rng(seed)
    w, sub = int(rng.choice([3, 10, 30])), f"{int(rng.choice([1, 2, 5, 60]))} seconds"
    rows, per_key, seq = [], {}, 0
    for key in ["a", "b", None]:
        t, evs = 0, []
        for _ in range(int(rng.integers(20, 100))):
            t += int(rng.choice([0, 0, 1, 2, 4, 7, 12, 25]))
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
        for start, end in brute_follow(evs, w).items():
            if end is None:
                assert start in late and start not in paid
            else:
                assert paid.get(start) == end and start not in late
