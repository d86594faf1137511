"""Main and side outputs of one stream (K6).

A stream whose rows name their output in a column is written once: the file sink puts each
output in a folder of its own and commits the micro-batch as one entry of its log. What a
micro-batch wrote to all outputs is there or none of it; a failure between two outputs
leaves files that no reader sees and the next run writes anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


class Outputs:
    """Outputs under ``root`` (a shared folder) by the values of ``tag``."""

    def __init__(self, spark: SparkSession, root: str, tag: str = "outcome"):
        self.spark, self.root, self.tag = spark, root.rstrip("/"), tag

    def writer(self, stream: DataFrame, checkpoint: str):
        """A stream writer; start it with any trigger."""
        self.schema = stream.schema
        return (stream.writeStream.outputMode("append").format("parquet").partitionBy(self.tag)
                .option("path", f"{self.root}/data").option("checkpointLocation", checkpoint))

    def read(self, *tags: str, schema: StructType | None = None) -> DataFrame:
        """The committed rows of some outputs (all without a name), without the tag: only their
        folders are read."""
        schema = schema or self.schema
        known = StructType([f if f.name != self.tag else f.__class__(f.name, StringType()) for f in schema])
        rows = self.spark.read.schema(known).parquet(f"{self.root}/data")
        return rows.where(F.col(self.tag).isin(*tags)).drop(self.tag) if tags else rows
