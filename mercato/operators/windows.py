"""Aggregations and event-time windows.

Measures are declared as ``{out_name: (kind, column)}`` with kind ``count``,
``sum``, ``money`` (sum as decimal), ``money_sum`` (sum of decimal partials),
``min`` or ``max``; all are decomposable, so Spark always
aggregates partially before the shuffle, and sliding windows can be computed
from panes.

Money is summed as ``decimal(18,2)`` and cast to double at the end: the sum
does not depend on row order, so it is the same on every run and partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import duration

MONEY = "decimal(18,2)"

Measures = dict[str, tuple[str, str | None]]


def _partial(kind: str, col: str | None) -> Column:
    c = F.col(col) if col else F.lit(1)
    if kind == "count":
        return F.count(c)
    if kind == "sum":
        return F.sum(c)
    if kind == "money":
        return F.sum(c.cast(MONEY))
    if kind == "money_sum":  # already decimal partial sums
        return F.sum(c)
    if kind == "min":
        return F.min(c)
    if kind == "max":
        return F.max(c)
    raise ValueError(f"unknown measure kind {kind!r}")


def _final(kind: str, name: str) -> Column:
    c = F.col(name)
    if kind in ("count", "sum", "money", "money_sum"):
        return F.sum(c)
    return F.min(c) if kind == "min" else F.max(c)


def _finish(kind: str, col: Column) -> Column:
    return col.cast("double") if kind in ("money", "money_sum") else col


def aggregate(df: DataFrame, keys: Iterable[str], measures: Measures) -> DataFrame:
    """Group totals, e.g. ``sum(totalMoney), count(1) group by city, province`` (A1)."""
    return df.groupBy(*keys).agg(*[
        _finish(kind, _partial(kind, col)).alias(name) for name, (kind, col) in measures.items()])


def _ts_type(df: DataFrame, ts: str) -> T.DataType:
    return df.schema[ts].dataType


def window_aggregate(df: DataFrame, ts: str, keys: Iterable[str], measures: Measures,
                     width, slide=None) -> DataFrame:
    """Tumbling or sliding epoch-aligned windows with ``F.window``.

    Each row is copied to every window that covers it (width / slide times).
    Output: keys, window_start, window_end, measures.
    """
    keys = list(keys)
    win = (F.window(ts, duration.text(width)) if slide is None
           else F.window(ts, duration.text(width), duration.text(slide)))
    out = df.groupBy(win.alias("_w"), *keys).agg(*[
        _finish(kind, _partial(kind, col)).alias(name) for name, (kind, col) in measures.items()])
    return out.select(*keys, F.col("_w.start").alias("window_start"),
                      F.col("_w.end").alias("window_end"), *measures.keys())


def pane_aggregate(df: DataFrame, ts: str, keys: Iterable[str], measures: Measures,
                   width, slide) -> DataFrame:
    """Sliding windows from slide-wide panes: the same rows as ``window_aggregate``.

    Rows are first combined per (keys, pane); only pane partials are copied to
    the width / slide windows that contain them. With 1 h / 5 s that is one
    copy per non-empty pane instead of 720 copies per row. ``slide`` must
    divide ``width``.
    """
    keys = list(keys)
    width_us, slide_us = duration.micros(width), duration.micros(slide)
    if width_us % slide_us:
        raise ValueError("pane windows need the slide to divide the width")
    n = width_us // slide_us
    ts_type = _ts_type(df, ts)
    panes = df.groupBy(*keys, F.window(ts, duration.text(slide)).start.alias("_pane")).agg(
        *[_partial(kind, col).alias(name) for name, (kind, col) in measures.items()])
    pane_us = F.unix_micros(F.col("_pane").cast("timestamp"))
    expanded = panes.select(
        *keys, *measures.keys(), pane_us.alias("_pane_us"),
        F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_i"))
    expanded = expanded.withColumn(
        "_start_us", F.col("_pane_us") - F.col("_i").cast("bigint") * slide_us)
    out = expanded.groupBy(*keys, "_start_us").agg(
        *[_final(kind, name).alias(name) for name, (kind, _) in measures.items()])
    start = F.timestamp_micros(F.col("_start_us"))
    end = F.timestamp_micros(F.col("_start_us") + width_us)
    return out.select(
        *keys, start.cast(ts_type).alias("window_start"), end.cast(ts_type).alias("window_end"),
        *[_finish(kind, F.col(name)).alias(name) for name, (kind, _) in measures.items()])


def _window_runs(events: DataFrame, keys: list[str], names: list[str], chunk: int) -> DataFrame:
    """Signed events ``(keys, _at, names)`` -> a row ``(_rk, _start, totals)`` per window start that
    has rows (the first of ``names`` counts them). Totals are running sums over ``_at``, in ranges
    of ``chunk`` with offsets, and stand until the key's next event."""
    events = events.select(F.struct(*[F.col(k) for k in keys], F.floor(F.col("_at") / chunk).alias("_chunk"))
                           .alias("_rk"), "_at", *names)
    net = events.repartition("_rk").groupBy("_rk", "_at").agg(*[F.sum(c).alias(c) for c in names])
    per_chunk = net.groupBy("_rk").agg(F.min("_at").alias("_first"), *[F.sum(c).alias(c) for c in names])
    order = Window.partitionBy(*[F.col(f"_rk.{k}") for k in keys]).orderBy("_rk._chunk")
    offsets = per_chunk.select(
        "_rk", F.lead("_first").over(order).alias("_next_first"),
        *[F.coalesce(F.sum(c).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"_o_{c}")
          for c in names])
    within = Window.partitionBy("_rk").orderBy("_at")
    total = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = net.join(offsets, "_rk").select(
        "_rk", "_at", F.coalesce(F.lead("_at").over(within), F.col("_next_first")).alias("_until"),
        *[(F.col(f"_o_{c}") + F.sum(c).over(total)).alias(c) for c in names])
    return rows.where(F.col(names[0]) > 0).withColumn("_start", F.explode(F.sequence("_at", F.col("_until") - 1)))


def sliding_distinct(df: DataFrame, ts: str, keys: Iterable[str], distinct_col: str, width, slide,
                     out: str = "user_count", chunk: int = 4096) -> DataFrame:
    """Exact distinct values per key in sliding windows (A5 over A2's windows).

    The windows that a value is in are the union of those of its panes. Per (key, value) each
    pane adds the windows that the pane before has not given: two signed events, whatever width /
    slide is. No window holds a set; a hot key is spread over its values, then over ranges of
    windows. NULL values do not count, as in ``count(distinct)``.
    """
    keys = list(keys)
    width_us, slide_us = duration.micros(width), duration.micros(slide)
    if width_us % slide_us:
        raise ValueError("pane windows need the slide to divide the width")
    n = width_us // slide_us
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    panes = df.where(F.col(ts).isNotNull()).select(
        *keys, F.col(distinct_col).alias("_value"), F.floor(us / slide_us).alias("_pane")).distinct()
    value = Window.partitionBy(*keys, "_value").orderBy("_pane")
    fresh = F.greatest(F.col("_pane") - (n - 1), F.lag("_pane").over(value) + 1)
    known = F.col("_value").isNotNull().cast("bigint")
    events = panes.select(*keys, known.alias("_u"), fresh.alias("_a"), (F.col("_pane") + 1).alias("_b")).select(
        *keys, F.explode(F.array(
            F.struct(F.col("_a").alias("_at"), F.lit(1).cast("bigint").alias("_rows"), F.col("_u").alias("_users")),
            F.struct(F.col("_b").alias("_at"), F.lit(-1).cast("bigint").alias("_rows"), (-F.col("_u")).alias("_users"))))
        .alias("_e")).select(*keys, "_e.*")
    # partial sums before the shuffle: many values enter a key's windows together
    events = events.groupBy(*keys, "_at").agg(F.sum("_rows").alias("_rows"), F.sum("_users").alias("_users"))
    spread = _window_runs(events, keys, ["_rows", "_users"], chunk)
    ts_type = _ts_type(df, ts)
    start = F.timestamp_micros(F.col("_start") * slide_us)
    end = F.timestamp_micros(F.col("_start") * slide_us + width_us)
    return spread.select(*[F.col(f"_rk.{k}").alias(k) for k in keys], start.cast(ts_type).alias("window_start"),
                         end.cast(ts_type).alias("window_end"), F.col("_users").alias(out))


def sliding_aggregate(df: DataFrame, ts: str, keys: Iterable[str], measures: Measures,
                      width, slide, chunk: int = 4096) -> DataFrame:
    """Sliding windows from two signed events per pane: the rows of ``window_aggregate``.

    A pane enters with the first window that covers it and leaves behind the last. Per key,
    the windows' totals are running sums of the entering and leaving amounts over the window
    starts, constant between two events, so whatever width / slide is, a pane is
    shuffled as two rows; the windows themselves are only written out at the end. Running sums
    are taken in ranges of ``chunk`` starts with offsets, so a hot key is many tasks.

    ``count``, ``sum`` of integers or decimals and ``money`` can be taken back; with other
    measures (``min``, ``max``, sums of doubles) use ``pane_aggregate``.
    """
    keys = list(keys)
    exact = {name: kind in ("count", "money", "money_sum") or (kind == "sum" and isinstance(
        df.schema[col].dataType, (T.IntegralType, T.DecimalType))) for name, (kind, col) in measures.items()}
    if not all(exact.values()):
        raise ValueError(f"cannot be taken back exactly: {[n for n, ok in exact.items() if not ok]}")
    width_us, slide_us = duration.micros(width), duration.micros(slide)
    if width_us % slide_us:
        raise ValueError("pane windows need the slide to divide the width")
    n = width_us // slide_us
    # a sum over nothing but NULLs is NULL: sums bring the count of their values
    known = {name: f"_known_{name}" for name, (kind, _) in measures.items() if kind != "count"}
    names = ["_rows", *measures, *known.values()]
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    panes = df.where(F.col(ts).isNotNull()).groupBy(*keys, F.floor(us / slide_us).alias("_pane")).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[_partial(kind, col).alias(name) for name, (kind, col) in measures.items()],
        *[F.count(measures[name][1]).alias(k) for name, k in known.items()])
    amounts = [F.coalesce(F.col(c), F.lit(0)) for c in names]
    events = panes.select(*keys, F.explode(F.array(
        F.struct((F.col("_pane") - (n - 1)).alias("_at"), *[a.alias(c) for c, a in zip(names, amounts)]),
        F.struct((F.col("_pane") + 1).alias("_at"), *[(-a).alias(c) for c, a in zip(names, amounts)]))).alias("_e"))
    spread = _window_runs(events.select(*keys, "_e.*"), keys, names, chunk)
    ts_type = _ts_type(df, ts)
    start = F.timestamp_micros(F.col("_start") * slide_us)
    end = F.timestamp_micros(F.col("_start") * slide_us + width_us)
    return spread.select(
        *[F.col(f"_rk.{k}").alias(k) for k in keys], start.cast(ts_type).alias("window_start"),
        end.cast(ts_type).alias("window_end"),
        *[(F.when(F.col(known[name]) > 0, _finish(kind, F.col(name))) if name in known else F.col(name)).alias(name)
          for name, (kind, _) in measures.items()])


def at_least(df: DataFrame, col: str, threshold: int) -> DataFrame:
    """Threshold filter after aggregation, ``count >= k`` (P10)."""
    return df.where(F.col(col) >= F.lit(threshold))


def distinct_count(df: DataFrame, ts: str, keys: Iterable[str], distinct_col: str, width,
                   out: str = "user_count", streaming: bool = False,
                   approximate: bool = False) -> DataFrame:
    """Exact distinct values per key and tumbling window (A5).

    Batch: ``count_distinct``, which Spark runs as two aggregations (first on
    key + value), so a hot key is spread over its values. Streams refuse
    ``count_distinct``; there the (window, key, value) triples are first
    deduplicated under the watermark and then counted, which keeps the same
    spread and never holds a set per key. ``approximate`` uses HyperLogLog++.
    """
    keys = list(keys)
    win = F.window(ts, duration.text(width))
    if approximate:
        agg = df.groupBy(win.alias("_w"), *keys).agg(
            F.approx_count_distinct(distinct_col).alias(out))
    elif not streaming:
        agg = df.groupBy(win.alias("_w"), *keys).agg(F.count_distinct(distinct_col).alias(out))
    else:
        agg = (df.withColumn("_w", win)
               .dropDuplicates(["_w", *keys, distinct_col])
               .groupBy("_w", *keys).agg(F.count(F.lit(1)).alias(out)))
    return agg.select(*keys, F.col("_w.start").alias("window_start"),
                      F.col("_w.end").alias("window_end"), out)


def running_totals(df: DataFrame, keys: Iterable[str], order_col: str, measures: Measures,
                   chunk: int = 1 << 16, then: Iterable[str] = ()) -> DataFrame:
    """Per-key running totals after each row, in ``order_col`` order (A1b), rows of
    equal ``order_col`` in the order of the ``then`` columns.

    A plain ``Window.partitionBy(keys)`` puts a whole key in one task. Here
    ``order_col`` (an integral order such as an order id) is cut into ranges of
    ``chunk`` values: totals per (key, range) are combined into offsets, then each
    (key, range) runs its own window and adds its offset. A task sees one key's
    rows of one range; ``sum``/``count``/``money`` only.
    """
    keys = list(keys)
    for kind, _ in measures.values():
        if kind not in ("count", "sum", "money"):
            raise ValueError("running totals support count, sum and money")
    chunk_id = F.floor(F.col(order_col) / F.lit(chunk))
    # one non-null key per (key, range); struct equality matches NULL fields, so
    # the offsets join and the range window share one partitioning: the rows
    # are shuffled once
    rows = df.withColumn("_rk", F.struct(*[F.col(k) for k in keys], chunk_id.alias("_chunk")))
    per_chunk = rows.groupBy("_rk").agg(
        *[_partial(kind, col).alias(f"_c_{name}") for name, (kind, col) in measures.items()])
    before = Window.partitionBy(*[F.col(f"_rk.{k}") for k in keys]).orderBy("_rk._chunk") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_chunk.select(
        "_rk", *[F.coalesce(F.sum(f"_c_{name}").over(before), F.lit(0)).alias(f"_o_{name}")
                 for name in measures])
    within = Window.partitionBy("_rk").orderBy(order_col, *then).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    joined = rows.join(offsets, "_rk", "inner")
    return joined.select(
        *df.columns,
        *[_finish(kind, F.col(f"_o_{name}") + _partial(kind, col).over(within)).alias(name)
          for name, (kind, col) in measures.items()])
