"""Time slices of a key that stay small whatever the key.

Window functions and pattern matchers take a key's rows slice by slice. A slice of fixed
width holds a third of all rows when one user clicks in one minute; here the slices
that are counted as heavy are cut at quantiles of their rows, so that no (key, slice) holds much
more than a thousandth of all rows (or ``most``).

Heavy slices number a thousand at most by their definition, and so do their cuts together,
so only these are broadcast; every other row keeps the fixed slice.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST = 1 << 16
FRACTION = 1000
BUCKETS = 1 << 16   # hashes that keys are counted by at first
PER_CUT = 256       # sampled rows between two cuts: slices differ by some six percent


def heavy_groups(df: DataFrame, group: str, most: int | None = None) -> DataFrame:
    """``(group, _rows, _limit)`` of the groups that hold more than ``most`` rows and a
    thousandth of all: a thousand groups at most."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_rows"))
    limit = sizes.agg(F.greatest(F.lit(most or MOST), F.ceil(F.sum("_rows") / FRACTION)).alias("_limit"))
    return sizes.crossJoin(limit).where("_rows > _limit")


def heavy_keys(df: DataFrame, keys: Iterable[str], most: int | None = None) -> DataFrame:
    """The ``keys`` that ``heavy_groups`` would name, found without a shuffle of all keys: rows are
    counted by a hash of their key first, and keys only where a hash holds as many rows as a heavy key."""
    keys = list(keys)
    rows = df.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("_bucket"))
    full = heavy_groups(rows, "_bucket", most).select("_bucket", "_limit")
    counts = rows.join(F.broadcast(full), "_bucket").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.first("_limit").alias("_limit"))
    return counts.where("_rows > _limit").select(*keys)


def sliced(df: DataFrame, keys: Iterable[str], at: Column, then: Column, slice_us: int,
           most: int | None = None) -> DataFrame:
    """``df`` with ``_ks``: the keys and, as ``_slice``, an ordered slice of ``(at, then)``.

    ``at`` are microseconds; ``then`` orders rows of one ``at``. One struct per (key,
    slice), because struct equality matches NULL fields.
    """
    keys = list(keys)
    rows = (df.withColumn("_cell", F.struct(*[F.col(k) for k in keys], F.floor(at / slice_us).alias("_h")))
            .withColumn("_place", F.struct(at.alias("t"), then.alias("s"))))
    heavy = heavy_groups(rows, "_cell", most)
    sample = (rows.select("_cell", "_place").join(F.broadcast(heavy), "_cell")
              .where(F.pmod(F.xxhash64("_place"), F.ceil(F.col("_limit") / PER_CUT)) == 0))
    rank = F.row_number().over(Window.partitionBy("_cell").orderBy("_place"))
    cuts = (sample.withColumn("_n", rank).where(F.col("_n") % PER_CUT == 0)
            .groupBy("_cell").agg(F.collect_list("_place").alias("_cuts")))
    rows = rows.join(F.broadcast(cuts), "_cell", "left")
    part = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= F.col("_place"))), F.lit(0))
    part = F.when(F.col("_cuts").isNull(), 0).otherwise(part)
    return rows.withColumn("_ks", F.struct(
        *[F.col(f"_cell.{k}").alias(k) for k in keys],
        F.struct(F.col("_cell._h").alias("h"), part.alias("p")).alias("_slice"))).drop(
            "_cell", "_place", "_cuts")
