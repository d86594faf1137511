"""Views kept up to date by signed rows: the add-retract changelog.

A change of a keyed table is the row it leaves behind: ``-1`` for what the row was
before, ``+1`` for what it is afterwards. Joins and totals are linear, so a view over the table
changes by the same operator applied to the signed rows: a join passes the sign on, a total
adds ``sign * value``. The sum over all signed rows is the view over the final
state; the running sums are the add-retract stream of the view.

``row_images`` finds what a row was and became, with column-level puts (K1b): a put overwrites
only the cells it carries, a deletion ends the row, a later put begins a new one. A
key's changes are one window. A key that holds more than a thousandth of them (``slices.heavy_keys``) is
taken slice by slice, the images handed on between slices, so that a third of the log is many tasks.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import slices, windows
from .changelog import DELETE_TYPE, KEY, ORDER, supported

DAY_US = 86_400_000_000
_PLACE = tuple(ORDER)


def _cells(fields: dict[str, tuple[str, str]]) -> dict[str, Column]:
    """What a put says about each cell: its text in a struct, NULL if it does not carry it."""
    return {name: F.when(F.map_contains_key("row", cell), F.struct(F.col("row")[cell].alias("v")))
            for name, (cell, _) in fields.items()}


def row_images(changes: DataFrame, fields: dict[str, tuple[str, str]],
               slice_us: int = DAY_US, most: int | None = None) -> DataFrame:
    """Every supported change with its row ``before`` and ``after`` (structs of the typed
    ``fields``: ``{name: (cell, type)}``; NULL where there is no row). Columns: database, table,
    row_key, es, change_id, pos, before, after."""
    said = _cells(fields)
    rows = supported(changes)
    rows = rows.select(*KEY, *ORDER, (F.lower("type") == DELETE_TYPE).alias("_gone"),
                       *[c.alias(f"_said_{n}") for n, c in said.items()])
    # read twice (the changes of heavy keys are counted first), derived once
    rows = materialize(rows)
    heavy = materialize(slices.heavy_keys(rows, KEY, most))
    if heavy.isEmpty():
        return _images(rows, fields)
    heavy = F.broadcast(heavy)
    return _images(rows.join(heavy, list(KEY), "left_anti"), fields).unionByName(
        _images_by_slice(rows.join(heavy, list(KEY), "left_semi"), fields, slice_us, most))


def _so_far(rows: DataFrame, names: Iterable[str], keys: Iterable[str]) -> DataFrame:
    """``rows`` with ``_life``, the deletions of the keys before a change, and what the row's present life
    (since the last deletion) has said so far, as ``_here_<name>``. All in one order of the rows."""
    order = Window.partitionBy(*keys).orderBy(*_PLACE)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_life", F.coalesce(F.sum(F.col("_gone").cast("int")).over(before), F.lit(0)))

    def here(name):
        said = F.col(f"_said_{name}")
        last = F.last(F.when(said.isNotNull(), F.struct("_life", said.alias("said"))), ignorenulls=True).over(so_far)
        return F.when(last["_life"] == F.col("_life"), last["said"]).alias(f"_here_{name}")

    return rows.select("*", *[here(n) for n in names])


def _images(rows: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """The images of keys whose changes meet in one task each."""
    key = KEY[::-1]     # the row key first, which tells rows apart soonest
    rows = _so_far(rows, fields, key)
    now = F.struct(*[F.col(f"_here_{n}")["v"].try_cast(kind).alias(n) for n, (_, kind) in fields.items()])
    rows = rows.select(*KEY, *ORDER, F.when(~F.col("_gone"), now).alias("after"))
    return rows.select(*KEY, *ORDER, F.lag("after").over(Window.partitionBy(*key).orderBy(*_PLACE)).alias("before"),
                       "after")


def _images_by_slice(rows: DataFrame, fields: dict[str, tuple[str, str]], slice_us: int, most: int | None) -> DataFrame:
    """The images of keys with many changes."""
    names = list(fields)
    # within a slice first
    rows = _so_far(slices.sliced(rows, KEY, F.col("es") * 1000, F.struct("change_id", "pos"), slice_us, most),
                   names, ["_ks"])

    # what each slice leaves behind, and what the slices before it leave to it
    newest = Window.partitionBy("_ks").orderBy(*[F.col(c).desc() for c in _PLACE])
    ended = (rows.withColumn("_n", F.row_number().over(newest)).where("_n = 1")
             .withColumn("_cut", F.col("_life") + F.col("_gone").cast("int")))
    key = [F.col(f"_ks.{k}") for k in KEY]
    order = Window.partitionBy(*key).orderBy("_ks._slice")
    ended = ended.withColumn("_era", F.sum("_cut").over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    era = (Window.partitionBy(*key, "_era").orderBy("_ks._slice")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # a life goes on through slices without a deletion; a slice that ends in one leaves nothing
    left = {n: F.when(~F.col("_gone"), F.last(F.when(~F.col("_gone"), F.col(f"_here_{n}")), ignorenulls=True).over(era))
            for n in names}
    ended = ended.select("_ks", F.col("_gone"), *[c.alias(f"_left_{n}") for n, c in left.items()])
    handed = ended.select("_ks", (~F.lag("_gone", 1, True).over(order)).alias("_was"),
                          *[F.lag(f"_left_{n}").over(order).alias(f"_from_{n}") for n in names])

    rows = rows.join(handed, "_ks")
    inherits = F.col("_life") == 0
    now = F.struct(*[F.coalesce(F.col(f"_here_{n}"), F.when(inherits, F.col(f"_from_{n}")))["v"]
                     .try_cast(fields[n][1]).alias(n) for n in names])
    then = F.struct(*[F.col(f"_from_{n}")["v"].try_cast(fields[n][1]).alias(n) for n in names])
    at = Window.partitionBy("_ks").orderBy(*_PLACE)
    rows = rows.withColumn("after", F.when(~F.col("_gone"), now))
    previous = F.lag("after").over(at)
    first = F.row_number().over(at) == 1
    return rows.select(*KEY, *ORDER, F.when(first, F.when(F.col("_was"), then)).otherwise(previous)
                       .alias("before"), "after")


def signed_rows(images: DataFrame, keep: Iterable[str] = (*KEY, *ORDER)) -> DataFrame:
    """The signed rows of ``row_images``: ``sign`` -1 or 1 beside the row's fields; a change that
    leaves the row as it was says nothing."""
    changed = images.where(~F.col("before").eqNullSafe(F.col("after")))
    both = F.filter(F.array(F.struct(F.lit(-1).alias("sign"), F.col("before").alias("row")),
                            F.struct(F.lit(1).alias("sign"), F.col("after").alias("row"))),
                    lambda x: x["row"].isNotNull())
    return changed.select(*keep, F.explode(both).alias("_x")).select(*keep, "_x.sign", "_x.row.*")


def totals(signed: DataFrame, keys: Iterable[str], money: str, total: str = "total_money",
           count: str = "order_count") -> DataFrame:
    """The totals that signed rows add up to; a group without rows is gone."""
    net = signed.groupBy(*keys).agg(
        F.sum(F.col(money).cast(windows.MONEY) * F.col("sign")).cast("double").alias(total),
        F.sum("sign").alias(count))
    return net.where(F.col(count) > 0)


def changelog_of_totals(signed: DataFrame, keys: Iterable[str], money: str, order: Iterable[str],
                        total: str = "total_money", count: str = "order_count") -> DataFrame:
    """The add-retract stream of the totals: per change and group the old totals with
    ``is_add`` false (if the group had rows) and the new ones with true (if it has any).

    ``order`` columns say when a change happened, the first of them integral; running sums
    are taken in ranges of it (``windows.running_totals``), so no group is one task.
    """
    keys, order = list(keys), list(order)
    net = signed.groupBy(*keys, *order).agg(
        F.sum(F.col(money).cast(windows.MONEY) * F.col("sign")).cast(windows.MONEY).alias("_money"),
        F.sum("sign").alias("_rows"))
    net = net.where("_money <> 0 or _rows <> 0 or _money is null")
    run = windows.running_totals(net, keys, order[0], {"_m": ("sum", "_money"), "_n": ("sum", "_rows")},
                                 chunk=86_400_000, then=order[1:])
    old = F.struct(F.lit(False).alias("is_add"), (F.col("_m") - F.coalesce("_money", F.lit(0))).alias("m"),
                   (F.col("_n") - F.col("_rows")).alias("n"))
    new = F.struct(F.lit(True).alias("is_add"), F.col("_m").alias("m"), F.col("_n").alias("n"))
    told = run.select(*keys, *order, F.explode(F.filter(F.array(old, new), lambda x: x["n"] > 0)).alias("_x"))
    return told.select(*keys, *order, "_x.is_add", F.col("_x.m").cast("double").alias(total),
                       F.col("_x.n").alias(count))
