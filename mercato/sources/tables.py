"""Parquet table scans. Column pruning, filter pushdown and the cutting of files
into splits (``spark.sql.files.maxPartitionBytes``) are left to Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
