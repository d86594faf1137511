"""Keyed tables as sources: range scans over a sorted store.

A keyed table is written in key order, a range of keys per file, so a scan of a key range
reads the files and row groups whose key statistics meet it: the bounds are pushed to the Parquet
scan, and only the named cells are read. Keys are compared as text, as a wide-column
store compares its row keys.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_keyed(rows: DataFrame, path: str, key: str = "row_key") -> None:
    """Write rows in key order; a range of keys per file."""
    rows.repartitionByRange(key).sortWithinPartitions(key).write.parquet(path)


def scan_keyed(spark: SparkSession, path: str, key: str = "row_key", start: str | None = None,
               stop: str | None = None, prefix: str | None = None,
               cells: Iterable[str] | None = None) -> DataFrame:
    """Rows with ``start <= key < stop`` (either may be left out), or of one ``prefix``."""
    rows = spark.read.parquet(path)
    if start is not None:
        rows = rows.where(F.col(key) >= F.lit(start))
    if stop is not None:
        rows = rows.where(F.col(key) < F.lit(stop))
    if prefix is not None:
        rows = rows.where(F.col(key).startswith(prefix))
    return rows if cells is None else rows.select(key, *cells)
