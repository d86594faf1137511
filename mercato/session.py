"""Session settings shared by the library, the tests and the benchmark."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "mercato", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks; on a cluster use the cluster's session."""
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files of collected DataFrames are removed by the context cleaner
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # streaming state in RocksDB: spills to disk instead of living on the heap
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings the operators rely on.

    Event times are read as TIMESTAMP_NTZ and the reference prints wall-clock
    times, so the session zone is pinned to UTC: epoch-aligned windows and
    epoch-millisecond conversions then agree with the oracle.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only on a local master (a
    test run, where one machine is all there is) may it be unset: a scratch
    folder is taken and removed at exit. On a cluster that is an error, since
    each executor would see a folder of its own.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if path and spark.sparkContext.getCheckpointDir():
        return path
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="mercato-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        try:
            spark.conf.set(CHECKPOINT_CONF, path)
        except Exception:  # a core setting the session refuses to change at runtime
            pass
    spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df):
    """Cut a long or many-times-reused lineage: write Parquet to the shared
    ``spark.checkpoint.dir`` and read it back (never a local checkpoint), so a lost
    executor costs a re-read, and the optimizer knows how large the rows are."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/mercato-tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
