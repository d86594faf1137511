"""Keyed stores on shared storage as append-only logs.

A store is a Parquet folder to which every micro-batch appends its rows; what it
holds is a query over the log: of each key the row of the greatest order. So

* a batch writes what it carries and nothing else, whatever the store's size;
* a late row cannot undo a newer one, and a deletion stays known, because order
  is decided when the store is read and not by arrival;
* applying a row twice changes nothing, so a batch replayed after a failure, or a
  new query with a new checkpoint over an old store, is harmless: with a
  checkpointed query the results are exactly-once.

``compact`` writes what is still needed to a new folder; it is an ordinary batch
job, run outside the write path.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class KeyedLog:
    """An append-only store at ``root`` (a shared folder); ``resolve`` gives the state
    of a log, ``partition_by`` columns become folders (one per table, say)."""

    def __init__(self, spark: SparkSession, root: str, schema: str,
                 resolve: Callable[[DataFrame], DataFrame], partition_by: tuple[str, ...] = ()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.resolve = resolve
        self.partition_by = partition_by

    def log(self) -> DataFrame:
        """All appended rows; empty only when the store does not exist yet (any other
        read error propagates)."""
        try:
            return self.spark.read.schema(self.schema).parquet(f"{self.root}/log")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], self.schema)
            raise

    def read(self) -> DataFrame:
        """The current state."""
        return self.resolve(self.log())

    def append(self, rows: DataFrame) -> None:
        rows.write.mode("append").option("compression", "zstd").partitionBy(*self.partition_by).parquet(f"{self.root}/log")

    def sink(self, shape: Callable[[DataFrame, int], DataFrame] = lambda batch, _: batch):
        """``foreachBatch`` function appending ``shape(batch, batch_id)``."""
        def write(batch: DataFrame, batch_id: int) -> None:
            self.append(shape(batch, batch_id))
        return write

    def compact(self, root: str, needed: Callable[[DataFrame], DataFrame]) -> "KeyedLog":
        """A store at ``root`` holding only the ``needed`` rows of this log. It is written beside
        and named last, so what a failed run left is never taken for a store."""
        smaller = KeyedLog(self.spark, root, self.schema, self.resolve, self.partition_by)
        draft = f"{smaller.root}/_log-{uuid.uuid4().hex}"
        needed(self.log()).write.option("compression", "zstd").partitionBy(*self.partition_by).parquet(draft)
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = path(draft).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(path(f"{smaller.root}/log")) or not fs.rename(path(draft), path(f"{smaller.root}/log")):
            raise ValueError(f"{smaller.root} already holds a store")
        return smaller
