"""Two-stream joins.

An interval condition on a plain key join is checked on every pair of the
key's rows, so one busy user costs rows x rows. Here time is cut into
buckets as wide as the interval: each left row names the (at most two)
buckets its interval touches, and the join is an equi-join on
(key, bucket) plus the exact interval test. Pairs are only formed between
rows that are close in time, and AQE can split a hot (key, bucket).

All conditions are two inequalities on the event-time columns, so the same
operators run on streams with watermarks and keep bounded state.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import duration
from ..session import materialize
from .slices import heavy_groups


def _us(col: str):
    return F.unix_micros(F.col(col).cast("timestamp"))


def _shift(ts: str, us: int):
    """``ts + us`` microseconds as an interval literal (watermark-friendly)."""
    if us >= 0:
        return F.col(ts) + duration.interval_us(us)
    return F.col(ts) - duration.interval_us(-us)


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_ts: str, right_ts: str, lower, upper) -> DataFrame:
    """Pairs with equal keys and ``left_ts + lower <= right_ts <= left_ts + upper``.

    Both ends inclusive, as ``intervalJoin().between(lower, upper)``. Column
    names of the two sides must differ.
    """
    lo, hi = duration.micros(lower), duration.micros(upper)
    if hi < lo:
        raise ValueError("upper bound below lower bound")
    width = max(hi - lo, 1)
    lb = F.explode(F.sequence(F.floor((_us(left_ts) + lo) / width),
                              F.floor((_us(left_ts) + hi) / width)))
    l2 = left.withColumn("_lb", lb)
    r2 = right.withColumn("_rb", F.floor(_us(right_ts) / width))
    cond = ((F.col(left_key) == F.col(right_key)) & (F.col("_lb") == F.col("_rb"))
            & (F.col(right_ts) >= _shift(left_ts, lo))
            & (F.col(right_ts) <= _shift(left_ts, hi)))
    return l2.join(r2, cond, "inner").drop("_lb", "_rb")


def window_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                left_ts: str, right_ts: str, width, most: int = 1 << 14) -> DataFrame:
    """Pairs with equal keys in the same epoch-aligned tumbling window.

    Adds ``window_start``/``window_end``. The window start is a plain equi-key. Groups that
    hold many left rows (``slices.heavy_groups``) are dealt to pieces, each of which meets the
    group's right rows, so one (key, window) with a third of all rows is many tasks.
    """
    w = duration.text(width)
    l2 = left.withColumn("_lw", F.window(left_ts, w)).withColumn(
        "_lg", F.struct(F.col(left_key).alias("k"), F.col("_lw.start").alias("w")))
    r2 = right.withColumn("_rg", F.struct(F.col(right_key).alias("k"), F.window(right_ts, w).start.alias("w")))
    heavy = F.broadcast(heavy_groups(l2, "_lg", most).select(
        F.col("_lg").alias("_hot"), F.ceil(F.col("_rows") / F.col("_limit")).cast("int").alias("_pieces")))
    pieces = F.coalesce("_pieces", F.lit(1))
    l2 = (l2.join(heavy, F.col("_lg") == F.col("_hot"), "left")
          .withColumn("_lp", F.pmod(F.xxhash64(*left.columns), pieces).cast("int")).drop("_hot", "_pieces"))
    r2 = (r2.join(heavy, F.col("_rg") == F.col("_hot"), "left")
          .withColumn("_rp", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("_hot", "_pieces"))
    joined = l2.join(r2, (F.col(left_key) == F.col(right_key)) & (F.col("_lg.w") == F.col("_rg.w"))
                     & (F.col("_lp") == F.col("_rp")), "inner")
    return joined.select(*left.columns, *right.columns,
                         F.col("_lw.start").alias("window_start"),
                         F.col("_lw.end").alias("window_end"))


def earliest_per_key(df: DataFrame, key: str, ts: str) -> DataFrame:
    """One row per key, the earliest (J6 input cleaning, see J6q).

    A plain ``min`` (hash aggregate) when only the time is carried, else ``row_number`` = 1;
    both are also applied on the map side, so a hot key costs one row per task.
    """
    others = [c for c in df.columns if c != key]
    if others == [ts]:
        return df.groupBy(key).agg(F.min(ts).alias(ts))
    first = Window.partitionBy(key).orderBy(F.col(ts).asc_nulls_last(), *[c for c in others if c != ts])
    return df.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def match_with_timeout(orders: DataFrame, pays: DataFrame, key: str, order_ts: str,
                       pay_ts: str, tolerance, dedupe: bool = True) -> DataFrame:
    """Match each order with its payment when they are at most ``tolerance`` apart.

    Full outer join on the key with ``|pay - order| <= tolerance`` written as
    two inequalities; ``outcome`` is ``matched``, ``unmatched_order`` or
    ``unmatched_pay`` (the two side outputs). Keys are deduplicated to their
    earliest row first. Output: order_id, order_ts, pay_ts, outcome.
    """
    o = orders.select(F.col(key).alias("_ok"), F.col(order_ts).alias("order_ts"))
    p = pays.select(F.col(key).alias("_pk"), F.col(pay_ts).alias("pay_ts"))
    # rows without a key match nothing; the flags say which side a row came from
    if dedupe:
        o, p = earliest_per_key(o, "_ok", "order_ts"), earliest_per_key(p, "_pk", "pay_ts")
    tol = duration.micros(tolerance)
    cond = ((F.col("_ok") == F.col("_pk"))
            & (F.col("pay_ts") >= _shift("order_ts", -tol))
            & (F.col("pay_ts") <= _shift("order_ts", tol)))
    o, p = o.withColumn("_ordered", F.lit(True)), p.withColumn("_paid", F.lit(True))
    j = o.join(p, cond, "full_outer")
    outcome = (F.when(F.col("_ordered").isNotNull() & F.col("_paid").isNotNull(), F.lit("matched"))
               .when(F.col("_ordered").isNotNull(), F.lit("unmatched_order"))
               .otherwise(F.lit("unmatched_pay")))
    return j.select(F.coalesce("_ok", "_pk").alias("order_id"), "order_ts", "pay_ts",
                    outcome.alias("outcome"))


# ---------------------------------------------------------------- J6q: arrival order


def _watermarked_arrivals(rows: DataFrame, chunk: int) -> DataFrame:
    """Rows with ``_wm``, the watermark before each arrives: what both sides have reached, less
    a millisecond. A running maximum over the whole log, taken in ranges of ``_seq``; one
    row per range is met in one task."""
    rows = rows.withColumn("_range", F.floor(F.col("_seq") / chunk))
    tops = [F.max(F.when(F.col("_side") == side, F.col("_t"))).alias(f"_top{side}") for side in (0, 1)]
    order = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("_range").agg(*tops).select(
        "_range", *[F.max(f"_top{side}").over(order).alias(f"_was{side}") for side in (0, 1)])
    within = Window.partitionBy("_range").orderBy("_seq").rowsBetween(Window.unboundedPreceding, -1)
    reached = [F.greatest(f"_was{side}", F.max(F.when(F.col("_side") == side, F.col("_t"))).over(within))
               for side in (0, 1)]
    low = F.when(reached[0].isNotNull() & reached[1].isNotNull(), F.least(*reached) - 1000)
    return rows.join(before, "_range").withColumn("_wm", low).drop("_was0", "_was1")


def _slot_machine(batches: Iterator, tol: int) -> Iterator:
    """The two slots over sorted (key, range) groups, in Arrow batches. A group's first row brings
    the state that the range before left; outcomes (kind 0) and the state at its end (kind 1)
    are sent. State: side and time in the slot, due times (ascending) of the timers that
    have not fired."""
    import heapq

    import pyarrow as pa

    columns = ("_k", "_range", "_start", "_side", "_t", "_wm", "_last", "_slot_side", "_slot_t", "_dues")
    group, out, kind = None, [], None
    side = t = None
    dues: list = []
    last = False

    def flush():
        if side is not None:
            out.append((*group, 0, *((t, None) if side == 0 else (None, t)),
                        "unmatched_order" if side == 0 else "unmatched_pay", None, None, None))

    def end():
        if last:
            flush()
        else:
            out.append((*group, 1, None, None, None, side, t if side is not None else None, sorted(dues)))

    def sent():
        schema = pa.schema([("_k", kind), ("_range", pa.int64()), ("_kind", pa.int32()), ("order_us", pa.int64()),
                            ("pay_us", pa.int64()), ("outcome", pa.string()), ("_slot_side", pa.int32()),
                            ("_slot_t", pa.int64()), ("_dues", pa.list_(pa.int64()))])
        values = zip(*out) if out else [[]] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)

    for batch in batches:
        kind = batch.schema.field("_k").type
        for key, rng, start, x_side, x_t, wm, is_last, s_side, s_t, s_dues in zip(
                *[batch.column(c).to_pylist() for c in columns]):
            if start:
                if group is not None:
                    end()
                group, last = (key, rng), bool(is_last)
                side, t, dues = s_side, s_t, list(s_dues or ())
                continue
            if dues and wm is not None and dues[0] <= wm:
                flush()                                 # a timer has fired, whoever set it
                side = None
                while dues and dues[0] <= wm:
                    heapq.heappop(dues)
            if side is not None and side != x_side:
                pair = (t, x_t) if side == 0 else (x_t, t)
                out.append((*group, 0, *pair, "matched", None, None, None))
                side = None
            else:
                side, t = x_side, x_t                   # an older row in the slot is lost
                heapq.heappush(dues, t + tol)
        yield sent()
        out = []
    if group is not None:
        end()
        yield sent()


WHOLE = 1 << 12     # arrivals of a key that are one range, wherever they lie


def match_in_arrival_order(orders: DataFrame, pays: DataFrame, key: str, order_ts: str, pay_ts: str,
                           seq: str, tolerance, chunk: int = 1 << 16) -> DataFrame:
    """The two-stream match as its two slots take the rows, in arrival order (J6q).

    Per key one slot is filled at most. A row that meets the other side in the slot matches it and
    empties the slot; else it takes the slot (a row of its own side there is lost) and sets a
    timer at its time + ``tolerance``. Timers are not taken back: once the watermark (both sides'
    latest time less a millisecond) reaches one, whatever is in the slot then leaves unmatched, also a
    newer row. The log's end fires all. ``seq`` is the arrival order over both sides, integral and
    unique. Output: order_id, order_ts, pay_ts, outcome; a key with repeated rows has several.

    The arrivals of a key with more than ``WHOLE`` (or ``chunk``) of them are taken in ranges of
    ``chunk`` numbers. All ranges run at once from an empty slot; a range whose predecessor left
    something else runs again from that, until all agree. Any other key is one range, done at once.
    """
    from pyspark.sql import types as T

    kind = orders.schema[key].dataType.simpleString()
    times = orders.schema[order_ts].dataType

    def side(df, ts, number):
        return df.select(F.col(key).alias("_k"), F.lit(number).alias("_side"), _us(ts).alias("_t"),
                         F.col(seq).cast("bigint").alias("_seq")).where("_k is not null and _t is not null")

    both = side(orders, order_ts, 0).unionByName(side(pays, pay_ts, 1))
    rows = materialize(_watermarked_arrivals(both, chunk))
    hot = rows.groupBy("_k").count().where(F.col("count") > min(WHOLE, chunk)).select(
        F.col("_k").alias("_hot"))
    rows = materialize(rows.join(hot, F.col("_k") == F.col("_hot"), "left")
                       .withColumn("_range", F.when(F.col("_hot").isNotNull(), F.col("_range")).otherwise(
                           F.lit(0).cast("bigint"))).drop("_hot"))
    state = {"_slot_side": "int", "_slot_t": "bigint", "_dues": "array<bigint>"}
    order = Window.partitionBy("_k").orderBy("_range")
    ranges = (rows.select("_k", "_range").distinct()
              .withColumn("_last", F.lead("_range").over(order).isNull())
              .withColumn("_first", F.lag("_range").over(order).isNull()))
    started = materialize(ranges.select("*", *[F.lit(None).cast(t).alias(c) for c, t in state.items()]))
    out = (f"_k {kind}, _range bigint, _kind int, order_us bigint, pay_us bigint, outcome string, "
           "_slot_side int, _slot_t bigint, _dues array<bigint>")
    tol = duration.micros(tolerance)

    def run(starts: DataFrame) -> DataFrame:
        heads = starts.select("_k", "_range", F.lit(True).alias("_start"), F.lit(None).cast("int").alias("_side"),
                              *[F.lit(None).cast("bigint").alias(c) for c in ("_t", "_wm", "_seq")], "_last", *state)
        body = rows if starts is started else rows.join(starts.select("_k", "_range"), ["_k", "_range"])
        body = body.select(
            "_k", "_range", F.lit(False).alias("_start"), "_side", "_t", "_wm", "_seq",
            F.lit(None).cast("boolean").alias("_last"), *[F.lit(None).cast(t).alias(c) for c, t in state.items()])
        dealt = heads.unionByName(body).repartition("_k", "_range").sortWithinPartitions(
            "_k", "_range", F.col("_seq").asc_nulls_first())
        return materialize(dealt.mapInArrow(lambda b: _slot_machine(b, tol), out))

    done = run(started)
    several = started.where("not (_first and _last)")
    while not several.isEmpty():
        left = several.drop(*state).join(done.where("_kind = 1").select("_k", "_range", *state), ["_k", "_range"], "left")
        now = left.select("_k", "_range", "_last", "_first", *[F.lag(c).over(order).alias(c) for c in state])
        before = several.select("_k", "_range", F.struct(*state).alias("_from"))
        stale = materialize(now.join(before, ["_k", "_range"]).where(~F.struct(*state).eqNullSafe(F.col("_from")))
                            .drop("_from"))
        if stale.isEmpty():
            break
        again = run(stale)
        done = materialize(done.join(stale.select("_k", "_range"), ["_k", "_range"], "left_anti").unionByName(again))
        several = materialize(several.join(stale.select("_k", "_range"), ["_k", "_range"], "left_anti")
                              .unionByName(stale.select(*several.columns)))
    ntz = isinstance(times, T.TimestampNTZType)
    return done.where("_kind = 0").select(
        F.col("_k").alias("order_id"),
        *[(F.timestamp_micros(us).cast("timestamp_ntz") if ntz else F.timestamp_micros(us)).alias(name)
          for us, name in (("order_us", "order_ts"), ("pay_us", "pay_ts"))], "outcome")
