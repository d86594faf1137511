"""J8 / J8n against a brute-force model, with buckets small enough that runs and
blocking cross bucket boundaries."""

import datetime as dt

import numpy as np
import pytest

from mercato.operators import patterns

T0 = dt.datetime(2024, 1, 1)


def brute(events, k, w):
    """events: sorted list of (t_seconds, seq) of one key -> (all matches, greedy matches)."""
    n = len(events)
    all_m = [(j - s + 1, events[s][0], events[j][0])
             for j in range(n) for s in range(0, j - k + 2) if events[j][0] - events[s][0] < w]
    skip, last = [], -1
    for j in range(n):
        s = j - k + 1
        if s > last and s >= 0 and events[j][0] - events[s][0] < w:
            skip.append((k, events[s][0], events[j][0]))
            last = j
    return sorted(all_m), sorted(skip)


@pytest.mark.parametrize("seed,k,factor,chunk", [(1, 3, 1, 1 << 20), (2, 4, 1, 5),
                                                 (3, 3, 2, 2), (4, 5, 3, 7),
                                                 (5, 3, 1, 3), (6, 2, 1, 1 << 20)])
def test_random_keys(spark, seed, k, factor, chunk):
    rng = np.random.default_rng(seed)
    w = 10
    rows, per_key = [], {}
    seq = 0
    for key in ["a", "b", None]:
        t = 0
        evs = []
        for _ in range(60):
            t += int(rng.choice([0, 1, 2, 3, 9, 15, 40]))
            evs.append((t, seq))
            rows.append((seq, key, "p", T0 + dt.timedelta(seconds=t)))
            seq += 1
        per_key[key] = evs
    df = spark.createDataFrame(rows, "offset long, uid string, product_id string, ts timestamp_ntz")
    got_all = patterns.repeated_all(df, ["uid", "product_id"], "ts", "offset", k,
                                    f"{w} seconds", slice_width=f"{factor} seconds",
                                    expand=True).collect()
    got_ends = patterns.repeated_all(df, ["uid", "product_id"], "ts", "offset", k, f"{w} seconds",
                                     slice_width=f"{factor} seconds").collect()
    got_skip = patterns.repeated_skip_past_last(df, ["uid", "product_id"], "ts", "offset", k,
                                                f"{w} seconds", slice_width=f"{factor} seconds",
                                                chunk_rows=chunk).collect()
    for key, evs in per_key.items():
        exp_all, exp_skip = brute(evs, k, w)

        def conv(rs):
            return sorted((r.click_count, int((r.start_ts - T0).total_seconds()),
                           int((r.end_ts - T0).total_seconds())) for r in rs if r.uid == key)
        assert conv(got_all) == exp_all, key
        assert conv(got_skip) == exp_skip, key
        # one row per end: the longest of its runs, and where the shortest starts
        longest = {}
        for r in got_all:
            if r.uid == key:
                longest.setdefault((r.end_ts, r.shortest_start_ts), []).append((r.click_count, r.start_ts))
        ends = [(r.end_ts, r.shortest_start_ts, r.click_count, r.start_ts) for r in got_ends if r.uid == key]
        assert {e[:2] for e in ends} == set(longest)
        assert all(any(x == e[2:] for x in longest[e[:2]]) for e in ends)
