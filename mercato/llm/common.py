"""Small helpers shared by the text operators."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the corpus, as it is."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation, and a
    frame used by several branches is computed once.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Rows of an Arrow batch for what is executed inside the block; for rows that hold
    much each, so that a batch stays small in a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def join_hot(rows: DataFrame, totals: DataFrame, keys: list[str], size: str, spread: str,
             least: int = 100_000) -> DataFrame:
    """``rows`` joined with ``totals`` (a written table), which holds one row per key and in
    ``size`` the number of its rows. A key of more than a thousandth of all rows (and ``least``)
    is hot: its rows are dealt to several tasks by ``spread``. There are at most a thousand
    hot keys, so only these are broadcast."""
    most = totals.agg(F.greatest(F.lit(least), F.ceil(F.sum(size) / 1000)).alias("__most"))
    hot = F.broadcast(totals.select(*keys, size).crossJoin(most).where(F.col(size) > F.col("__most"))
                      .select(*keys, F.ceil(F.col(size) / F.col("__most")).cast("int").alias("__pieces")))
    piece = F.coalesce(F.pmod(F.xxhash64(spread), F.col("__pieces")).cast("int"), F.lit(0))
    salted = rows.join(hot, keys, "left").withColumn("__salt", piece).drop("__pieces")
    dealt = totals.join(hot, keys, "left").withColumn("__salt", F.explode(
        F.sequence(F.lit(0), F.coalesce("__pieces", F.lit(1)) - 1))).drop("__pieces")
    return salted.join(dealt, [*keys, "__salt"]).drop("__salt")


def named(column: str, name: str):
    """A column under a name; without an alias where it has that name already (two
    frames with and without a redundant alias do not share an exchange)."""
    return F.col(f"`{column}`") if column == name else F.col(f"`{column}`").alias(name)


_KEPT: dict[str, object] = {}


def kept(key: str, make):
    """``make()``, which a worker process keeps for its next tasks under ``key``. Workers serve one
    operator after the other, so they keep one such thing: a new one, or texts that another operator
    takes (``texts_of``), let the last one go, with memory that Arrow holds unused."""
    if key not in _KEPT:
        _let_go()
        _KEPT[key] = make()
    return _KEPT[key]


def _let_go() -> None:
    import pyarrow as pa

    _KEPT.clear()
    pa.default_memory_pool().release_unused()


def texts_of(column, max_bytes: int = 4 << 20, keeps: str | None = None):
    """Cut an Arrow text column into runs of at most ``max_bytes`` (one text at
    least): yields lists of str, null as ''. Bounds what a task holds as Python
    objects whatever the batch size. ``keeps`` names what the operator has ``kept``."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if _KEPT and keeps not in _KEPT:
        _let_go()
    if not len(column):
        return
    sizes = pc.fill_null(pc.binary_length(column.cast(pa.large_string())), 0).to_numpy(
        zero_copy_only=False)
    ends = sizes.cumsum()
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(ends.searchsorted(base + max_bytes, "right")))
        yield [x or "" for x in column.slice(start, stop - start).to_pylist()]
        start = stop
