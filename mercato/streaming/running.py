"""Running totals per key on a stream (A1b), as orders arrive.

Each micro-batch is numbered and summed by the batch operator, which splits a key's
rows into ranges and adds range offsets, so a key that holds most of the stream is
spread over many tasks. What the batches before brought to a key are their increments
(``streaming.increments``); the batch's own totals start from there. No watermark wait: a
row's total leaves with its batch.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import windows
from .increments import Increments

DAY_US = 86_400_000_000


class RunningTotals:
    """Totals after each row, in (``ts``, ``seq``) order within a batch, batch after
    batch.

    ``sink`` is the ``foreachBatch`` function. Rows and increments of a batch are in folders
    of its run and number, which a replay writes again: every row is there once, rows that
    repeat an identifier or have none as often as they came. A query with a new checkpoint
    over old totals needs a ``run`` name of its own. ``keys`` as DDL.
    """

    def __init__(self, spark: SparkSession, root: str, keys: str, id_col: str, money: str,
                 ts: str, seq: str, run: str = "0", every: int = 100):
        self.spark, self.root = spark, root.rstrip("/")
        self.id_col, self.money, self.ts, self.seq = id_col, money, ts, seq
        self.increments = Increments(spark, root, keys, run, every)
        self.keys = self.increments.keys

    def sink(self, batch: DataFrame, batch_id: int) -> None:
        self.increments.carry(batch_id)
        batch = batch.select(*dict.fromkeys([*self.keys, self.id_col, self.money, self.ts, self.seq])).persist()
        try:
            if batch.isEmpty():
                return
            keyed = batch.groupBy(*self.keys).agg(
                F.sum(F.col(self.money).cast(windows.MONEY)).alias("money"), F.count(F.lit(1)).alias("n"))
            rows = windows.running_totals(
                batch.withColumn("_at", F.unix_micros(self.ts)), self.keys, "_at",
                {"_m": ("money", self.money), "_n": ("count", None)}, DAY_US, [self.seq])
            before = self.increments.before(batch_id).select(
                *[F.col(k).alias(f"_k_{k}") for k in self.keys], F.col("money").alias("_m0"), F.col("n").alias("_n0"))
            same = F.lit(True)
            for k in self.keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
            zero = F.lit(0)
            (rows.join(before, same, "left").select(
                *self.keys, self.id_col,
                (F.coalesce("_m0", zero) + F.coalesce(F.col("_m").cast(windows.MONEY), zero)).cast("double")
                .alias("running_money"),
                (F.coalesce("_n0", zero) + F.col("_n")).cast("bigint").alias("running_count"))
             .write.mode("overwrite").parquet(
                 f"{self.root}/rows/run={self.increments.name}/batch={batch_id}"))
            self.increments.add(keyed, batch_id)
        finally:
            batch.unpersist()

    def read(self) -> DataFrame:
        try:
            return self.spark.read.parquet(f"{self.root}/rows").drop("run", "batch")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                raise ValueError("no batch was written") from e
            raise
