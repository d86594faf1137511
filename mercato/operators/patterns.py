"""Event patterns.

J7 "A then B within W" finds each start's nearest following end with a
backwards window per (key, minute), and across minutes from one summary row
per active minute: linear, no pairs, no group larger than a key-minute.

J8 "k or more events of a key within W" works on positions: every event gets its
number in its key's (time, seq) order. A key is cut into short time slices
(``slice_width``, whatever W is; heavy ones are cut at quantiles, ``operators.slices``): slices
are counted, the counts summed to offsets (one
row per non-empty slice), and events numbered inside their slice, so a key that holds
a third of all rows is spread over its slices. Rows k-1 apart then meet in an equi-join
on (key, position), which deals a hot key evenly.

* No skip (J8n): each end event closes a run of every length from k to the events
  in its W. How many lie in W follows from the number of events up to ``t - W``, found
  by numbering probes at ``t - W`` among the events, slice by slice as above.
* Skip past last (J8): picks are greedy in event order (a pick at j blocks every later
  match starting at or before j). The only thing a segment of the sequence needs from
  the past is how many of its first positions are blocked, a number in ``0 .. k-1``. So
  each segment (``chunk_rows`` positions of a key) maps entry state -> exit state (a table
  of k numbers, computed in pandas on its candidate positions, streamed through
  ``mapInPandas`` one segment at a time), one small pass per key chains those tables
  in order (one row per segment, not per event), and a last pass replays every segment
  from its true entry state. Segments whose candidates cannot overlap skip all of
  this (every candidate is a pick).
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import duration
from ..session import materialize
from .slices import sliced

# ---------------------------------------------------------------- J7 / J7t


def _us(col: str):
    return F.unix_micros(F.col(col).cast("timestamp"))


def _first_follower(events: DataFrame, key: str, ts: str, seq: str, start_cond,
                    end_cond, within, payload: Iterable[str],
                    sub_bucket="1 minute") -> DataFrame:
    """Every start row with the first end row after it, if that end is within W.

    No pairs are formed, and no group is larger than one key's events of one
    ``sub_bucket`` of time:

    1. per (key, sub-bucket), ordered backwards in (time, seq), the nearest
       following end inside the sub-bucket is the last end seen so far
       (``last(ignorenulls)`` over a growing frame: linear);
    2. per key, over one row per active sub-bucket, the first end of the next
       sub-bucket that has one (same backwards window, on the summary);
    3. a start takes (1) if it has one, else (2), joined on (key, sub-bucket).

    Output: order_id, start_seq, start_ts, payload, end_seq, end_ts (NULL when
    the first end is missing or too late).
    """
    payload = list(payload)
    w_us = duration.micros(within)
    s_us = max(1, min(duration.micros(sub_bucket), w_us))
    is_start = F.coalesce(start_cond, F.lit(False))
    is_end = F.coalesce(end_cond, F.lit(False))
    rows = (events.where(is_start | is_end)
            .select(F.col(key).alias("order_id"), F.col(seq).alias("_seq"),
                    F.col(ts).alias("_ts"), _us(ts).alias("_t"), *payload,
                    is_start.alias("_start"), is_end.alias("_end"))
            # one non-null key per (key, sub-bucket): the window, the summary and
            # the join below share its partitioning (struct equality matches NULLs)
            .withColumn("_bk", F.struct(F.col("order_id").alias("k"),
                                        F.floor(F.col("_t") / s_us).alias("b"))))
    end_here = F.when(F.col("_end"), F.struct(F.col("_t").alias("t"), F.col("_seq").alias("seq"),
                                              F.col("_ts").alias("ts")))
    back = (Window.partitionBy("_bk").orderBy(F.desc("_t"), F.desc("_seq"))
            .rowsBetween(Window.unboundedPreceding, -1))
    starts = (rows.select("*", F.last(end_here, ignorenulls=True).over(back).alias("_in"))
              .where(F.col("_start")))
    # one row per (key, active sub-bucket): its first end, if any
    buckets = rows.groupBy("_bk").agg(F.min(end_here).alias("_first"))
    later = (Window.partitionBy("_bk.k").orderBy(F.desc("_bk.b"))
             .rowsBetween(Window.unboundedPreceding, -1))
    after = buckets.select("_bk", F.last("_first", ignorenulls=True).over(later).alias("_after"))
    found = (starts.join(after, "_bk", "left")
             .withColumn("_next", F.coalesce("_in", "_after"))
             .withColumn("_ok", F.col("_next.t") - F.col("_t") < w_us))
    return found.select(
        "order_id", F.col("_seq").alias("start_seq"), F.col("_ts").alias("start_ts"), *payload,
        F.when(F.col("_ok"), F.col("_next.seq")).alias("end_seq"),
        F.when(F.col("_ok"), F.col("_next.ts")).alias("end_ts"))


def followed_by(events: DataFrame, key: str, ts: str, seq: str, start_cond, end_cond,
                within, payload: Iterable[str] = (), sub_bucket="1 minute") -> DataFrame:
    """Completed matches of "start, later end, within W" per key.

    Every start row opens its own attempt; events in between are skipped; the
    first end after the start (ties: later ``seq``) completes it if
    ``t_end - t_start < W``. Output: order_id, start_seq, start_ts, payload,
    end_seq, end_ts.
    """
    found = _first_follower(events, key, ts, seq, start_cond, end_cond, within, payload,
                            sub_bucket)
    return found.where(F.col("end_seq").isNotNull())


def timed_out(events: DataFrame, key: str, ts: str, seq: str, start_cond, end_cond,
              within, payload: Iterable[str] = (), sub_bucket="1 minute") -> DataFrame:
    """Start rows that no end completes within W (J7t, the timeout side output)."""
    found = _first_follower(events, key, ts, seq, start_cond, end_cond, within, payload,
                            sub_bucket)
    return found.where(F.col("end_seq").isNull()).drop("end_seq", "end_ts")


# ---------------------------------------------------------------- J8 / J8n


def _offsets(rows: DataFrame, counted) -> DataFrame:
    """Per slice (``_ks``: keys and slice) the ``counted`` rows of the key before it."""
    per = rows.groupBy("_ks").agg(F.sum(counted).alias("_c"))
    keys = [f for f in per.schema["_ks"].dataType.names if f != "_slice"]
    before = (Window.partitionBy(*[F.col(f"_ks.{k}") for k in keys]).orderBy("_ks._slice")
              .rowsBetween(Window.unboundedPreceding, -1))
    return per.select("_ks", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"))


def _numbered(events: DataFrame, keys: list[str], ts: str, seq: str, payload: list[str],
              slice_us: int) -> DataFrame:
    """Events with their position (1, 2, ...) in their key's (time, seq) order; ``_key``
    is the key as one struct. Events without a time are left out."""
    base = events.select(*keys, F.col(seq).alias("_seq"), F.col(ts).alias("_ts"),
                         *payload).withColumn("_t", _us("_ts")).where(F.col("_t").isNotNull())
    # read twice (heavy slices are counted first), derived once
    rows = sliced(materialize(base), keys, F.col("_t"), F.col("_seq"), slice_us)
    order = Window.partitionBy("_ks").orderBy("_t", "_seq")
    rows = rows.join(_offsets(rows, F.lit(1)), "_ks")
    return (rows.withColumn("_pos", F.col("_before") + F.row_number().over(order))
            .withColumn("_key", F.struct(*[F.col(k) for k in keys]))
            .drop("_ks", "_before"))


def _events_before(rows: DataFrame, keys: list[str], w_us: int, slice_us: int) -> DataFrame:
    """``rows`` with ``_old``, the number of their key's events at ``t - W`` or before."""
    columns = rows.columns
    probes = rows.withColumns({"_x": F.col("_t") - w_us, "_probe": F.lit(1)})
    light = rows.select(*[F.col(c) if c in (*keys, "_pos") else F.lit(None).cast(t).alias(c)
                          for c, t in rows.dtypes], F.col("_t").alias("_x"), F.lit(0).alias("_probe"))
    both = sliced(light.unionByName(probes), keys, F.col("_x"), F.struct("_probe", "_pos"), slice_us)
    event = 1 - F.col("_probe")
    so_far = (Window.partitionBy("_ks").orderBy("_x", "_probe")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = both.join(_offsets(both, event), "_ks")
    return (both.withColumn("_old", F.col("_before") + F.sum(event).over(so_far))
            .where("_probe = 1").select(*columns, "_old"))


def _at(rows: DataFrame, numbered: DataFrame, position, **columns: str) -> DataFrame:
    """``rows`` with columns of their key's event at ``position`` (name = column there)."""
    there = numbered.select(F.col("_key").alias("_there_key"), F.col("_pos").alias("_there_pos"),
                            *[F.col(c).alias(name) for name, c in columns.items()])
    here = rows.withColumn("_want", position)
    return (here.join(there, (F.col("_key") == F.col("_there_key"))
                      & (F.col("_want") == F.col("_there_pos")))
            .drop("_there_key", "_there_pos", "_want"))


def repeated_all(events: DataFrame, keys: Iterable[str], ts: str, seq: str, times: int,
                 within, payload: Iterable[str] = (), slice_width="1 hour",
                 expand: bool = False) -> DataFrame:
    """Runs of ``times`` or more consecutive events of a key spanning < W (J8n).

    An end event closes a run of every length from ``times`` to the events in its W.
    One output row per end: keys, click_count of the longest run, payload of its second
    event, its start_ts, where the shortest run starts, end_ts. With ``expand`` a row
    for every run (quadratic in the events of a W).
    """
    keys, payload = list(keys), list(payload)
    k, slice_us = int(times), duration.micros(slice_width)
    if k < 2:
        raise ValueError("a repetition pattern needs at least 2 events")
    # numbered once, met several times: written to the shared checkpoint folder
    numbered = materialize(_numbered(events, keys, ts, seq, payload, slice_us))
    slim = numbered.drop(*payload)
    ends = _events_before(slim, keys, duration.micros(within), slice_us)
    ends = ends.withColumn("_cnt", F.col("_pos") - F.col("_old")).where(F.col("_cnt") >= k)
    count = F.col("_cnt").cast("bigint")
    lengths = F.explode(F.sequence(F.lit(k).cast("bigint"), count)) if expand else count
    ends = ends.withColumnRenamed("_ts", "end_ts").withColumn("click_count", lengths)
    ends = _at(ends, numbered, F.col("_pos") - F.col("click_count") + 1, start_ts="_ts")
    ends = _at(ends, numbered, F.col("_pos") - (k - 1), shortest_start_ts="_ts")
    if payload:
        ends = _at(ends, numbered, F.col("_pos") - F.col("click_count") + 2, **{p: p for p in payload})
    return ends.select(*keys, "click_count", *payload, "start_ts", "shortest_start_ts", "end_ts")


def _exit_state(cands: np.ndarray, n_own: int, k: int, entry: int) -> tuple[int, list[int]]:
    """Greedy picks over sorted own positions (1-based) from a blocked prefix."""
    picks, floor = [], entry + 1
    i = np.searchsorted(cands, floor)
    while i < len(cands):
        p = int(cands[i])
        picks.append(p)
        i = np.searchsorted(cands, p + k, side="left")
    if picks:
        return max(0, picks[-1] + k - 1 - n_own), picks
    return max(0, entry - n_own), picks


def _nsjoin(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``cols`` where NULL keys match each other (a NULL uid is a key too)."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in cols],
                     *[c for c in right.columns if c not in cols])
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in cols])


def _stream_groups(df: DataFrame, group_cols: list[str], order_cols: list[str], per_group,
                   schema: str) -> DataFrame:
    """``per_group(pdf) -> pdf`` for every group, holding one group at a time.

    Rows are hash-partitioned by the group columns and sorted within each
    partition; ``mapInPandas`` then walks the partition's Arrow batches and only
    keeps the group that may continue into the next batch. Unlike a grouped
    ``applyInPandas``, nothing larger than one group is ever in memory, and the
    groups here are bounded (a segment, or one key's segment summaries).
    """
    # no explicit count: AQE may merge small partitions, and a merged partition
    # still holds whole groups
    ordered = df.repartition(*group_cols).sortWithinPartitions(*group_cols, *order_cols)

    def run(batches):
        carry = None
        for pdf in batches:
            if carry is not None and len(carry):
                pdf = pd.concat([carry, pdf], ignore_index=True)
            if not len(pdf):
                continue
            gid = pdf.groupby(group_cols, dropna=False, sort=False).ngroup().to_numpy()
            open_ = gid == gid[-1]  # sorted input: the last group is at the end
            carry, done = pdf[open_], pdf[~open_]
            if len(done):
                out = [per_group(g) for _, g in
                       done.groupby(group_cols, dropna=False, sort=False)]
                yield pd.concat(out, ignore_index=True)
        if carry is not None and len(carry):
            yield per_group(carry)

    return ordered.mapInPandas(run, schema)


def repeated_skip_past_last(events: DataFrame, keys: Iterable[str], ts: str, seq: str,
                            times: int, within, payload: Iterable[str] = (),
                            slice_width="1 hour", chunk_rows: int = 1 << 16) -> DataFrame:
    """Runs of ``times`` events within W, each event used at most once.

    A match is emitted at its ``times``-th event and all its events are
    discarded, so every match has exactly ``times`` events. Output: keys, click_count,
    payload of the second event, start_ts, end_ts.

    Fast path: in a segment whose candidate ends are at least ``times`` positions
    apart (and none reaches back into the previous segment) every candidate is
    picked; this is decided with window functions, no Python. Only segments with
    overlapping candidates take the state-machine path.
    """
    keys, payload = list(keys), list(payload)
    k, chunk = int(times), int(chunk_rows)
    if k < 2:
        raise ValueError("a repetition pattern needs at least 2 events")
    w_us = duration.micros(within)
    # numbered once, met several times: written to the shared checkpoint folder
    numbered = materialize(_numbered(events, keys, ts, seq, payload, duration.micros(slice_width)))
    slim = numbered.drop(*payload)
    ends = _at(slim, numbered, F.col("_pos") - (k - 1), _start_t="_t", start_ts="_ts")
    segment = F.floor((F.col("_pos") - 1) / chunk)
    seg = [*keys, "_chunk"]
    cands = (ends.where(F.col("_t") - F.col("_start_t") < w_us)
             .withColumn("_chunk", segment)
             .withColumn("_cidx", F.col("_pos") - F.col("_chunk") * chunk))
    cands = materialize(cands.select(*seg, "_pos", "_cidx", "_key", "_ts", "start_ts"))
    gap = F.col("_cidx") - F.lag("_cidx").over(Window.partitionBy(*seg).orderBy("_cidx"))
    # A segment whose candidates are k or more apart and none reaches back into the
    # previous segment picks every candidate whatever its entry state, and leaves a
    # constant exit state: no Python for it. (A key's first candidate is at k or later.)
    per_segment = (cands.withColumn("_gap", gap).groupBy(*seg)
                   .agg(F.bool_and((F.col("_cidx") >= k) & (F.coalesce("_gap", F.lit(k)) >= k))
                        .alias("_simple"), F.max("_cidx").alias("_last")))
    sizes = slim.groupBy(*keys, segment.alias("_chunk")).agg(F.count(F.lit(1)).alias("_cn"))
    cands = _nsjoin(cands, per_segment.select(*seg, "_simple"), seg)
    fast = cands.where(F.col("_simple"))
    slow = _nsjoin(cands.where(~F.col("_simple")), sizes, seg)
    # every segment of a key with a slow segment takes part in the chain: simple ones
    # with a constant exit table, those without candidates with none (the state just
    # runs down)
    slow_keys = per_segment.where(~F.col("_simple")).select(*keys).distinct()
    segments = _nsjoin(_nsjoin(sizes, slow_keys, keys), per_segment, seg, "left")
    segments = segments.withColumn("_const", F.when(F.col("_simple"), F.array_repeat(
        F.greatest(F.lit(0), F.col("_last") + k - 1 - F.col("_cn")).cast("int"), k)))

    seg_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                           for f in slow.select(*seg).schema.fields)

    def tables(g: pd.DataFrame) -> pd.DataFrame:
        c = g["_cidx"].to_numpy()
        n = int(g["_cn"].iloc[0])
        row = g[seg].iloc[:1].copy()
        row["_exits"] = [[_exit_state(c, n, k, e)[0] for e in range(k)]]
        return row

    exit_tables = _stream_groups(slow.select(*seg, "_cidx", "_cn"), seg, ["_cidx"], tables,
                                 f"{seg_schema}, _exits array<int>")
    summary = (_nsjoin(segments.select(*seg, "_cn", "_const"), exit_tables, seg, "left")
               .withColumn("_exits", F.coalesce("_exits", "_const")).drop("_const"))

    def chain(g: pd.DataFrame) -> pd.DataFrame:
        state, entries = 0, []
        for n, exits in zip(g["_cn"].to_numpy(), g["_exits"]):
            entries.append(state)
            if exits is None or (isinstance(exits, float) and np.isnan(exits)):
                state = max(0, state - int(n))
            else:
                state = int(exits[state])
        res = g[seg].copy()
        res["_entry"] = entries
        return res[g["_exits"].notna().to_numpy()]

    entries = _stream_groups(summary, keys, ["_chunk"], chain, f"{seg_schema}, _entry int")

    def replay(g: pd.DataFrame) -> pd.DataFrame:
        c = g["_cidx"].to_numpy()
        _, picks = _exit_state(c, int(g["_cn"].iloc[0]), k, int(g["_entry"].iloc[0]))
        res = g[seg].iloc[[0] * len(picks)].reset_index(drop=True)
        res["_cidx"] = np.asarray(picks, dtype="int64")
        return res

    picks = _stream_groups(
        _nsjoin(slow.select(*seg, "_cidx", "_cn"), entries, seg),
        seg, ["_cidx"], replay, f"{seg_schema}, _cidx bigint")
    slow_picks = _nsjoin(slow, picks, [*seg, "_cidx"])
    found = fast.select(*keys, "_key", "_pos", "start_ts", "_ts").unionByName(
        slow_picks.select(*keys, "_key", "_pos", "start_ts", "_ts"))
    if payload:
        found = _at(found, numbered, F.col("_pos") - (k - 2), **{p: p for p in payload})
    return found.select(*keys, F.lit(k).cast("bigint").alias("click_count"), *payload, "start_ts",
                        F.col("_ts").alias("end_ts"))
