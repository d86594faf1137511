"""Replay a derived table as a file stream, and run a streaming query to its end.

A table of messages is written as JSON-lines files in log order, a streaming job reads
them with ``availableNow`` (``batch_files`` of them per micro-batch), and its sink output is
read back as a static DataFrame. A file holds a bounded number of rows, so the sort
that writes it does too; a log larger than a few files has more files to a micro-batch.
All folders live under the session's shared ``spark.checkpoint.dir``; each run takes
a fresh one. A feed is written compressed (JSON of one kind of message shrinks to less than a
tenth), its rows travel to their place in the log before their messages are written where a
``shape`` says how, and what only the feed or the run needed goes when that is done.

A replayed log is finite, so it ends with a marker: one message dated
``END_OF_LOG`` that moves the watermark past everything and is dropped behind it
(``jobs.watermarked``). Open windows, timeouts and pending events then leave, as
they do when a bounded input ends.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sinks.outputs import Outputs

LOG_BATCHES = 4          # micro-batches of a replayed log, its tail apart
FILE_ROWS = 100_000      # rows of a file, about; a compressed file is read by one task
FILE_BYTES = "8m"        # of compressed files that a task of a replay reads, about

# of a replay, whose checkpoint goes with it: state as small as may be, and no versions for a restart far back
STATE_ON_DISK = {"spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
                 "spark.sql.streaming.minBatchesToRetain": "2"}
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"   # with the query, not with the driver's GC
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/mercato-streams/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings inside the block; they are restored."""
    old = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def drop(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def kept(df: DataFrame):
    """``df`` as a table that is there inside the block: derived once, read as often as need be."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/mercato-tables/{uuid.uuid4().hex}"
    try:
        with settings(spark, {SHUFFLE_CLEANUP: "true"}):
            df.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        drop(spark, path)


def write_feed(df: DataFrame, path: str, order: Column | str, files: int | None = None,
               tail: list[DataFrame] | None = None, shape: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Write ``df`` as at most ``files`` JSON-lines files in the order of ``order``; without
    ``files`` as many as its rows ask for (``FILE_ROWS`` a file, ``LOG_BATCHES`` at least).

    The rows are range-partitioned and sorted by ``order`` (NULLs first; a string names a column of
    theirs), so a range is a contiguous stretch of the log and holds about as many rows as any other.
    They are derived once, into a table that is counted and sampled for the ranges and goes with
    the call. With a ``shape`` the rows are short ones that cost little to derive and are not kept;
    it makes messages of them once they are in order. A file stream follows modification times, which
    a parallel write leaves in any order, so they are set to the order of the ranges afterwards.
    ``tail`` frames (late rows, the end marker) follow, one file each, in micro-batches of their own:
    the log's files are filled up to whole micro-batches with empty ones.
    """
    spark = df.sparkSession
    named = isinstance(order, str)
    rows = df if named else df.withColumn("_order", order)
    place = F.col(order if named else "_order").asc_nulls_first()
    fill = files is None
    with contextlib.ExitStack() as held:
        if fill:
            if shape is None:
                rows = held.enter_context(kept(rows))
            files = max(LOG_BATCHES, -(-rows.count() // FILE_ROWS))
        rows = rows.repartitionByRange(files, place).sortWithinPartitions(place)
        messages = shape(rows) if shape else rows if named else rows.drop("_order")
        held.enter_context(settings(spark, {SHUFFLE_CLEANUP: "true"}))
        messages.write.option("compression", "gzip").json(path)
    if fill:
        _fill(spark, path)
    for extra in tail or []:
        extra.select(*messages.columns).coalesce(1).write.option("compression", "gzip").mode("append").json(f"{path}/_tail")
        _move(spark, f"{path}/_tail", path)
    _in_order(spark, path)
    return path


def batch_files(spark: SparkSession, path: str) -> int:
    """Files of a feed per micro-batch: its log makes ``LOG_BATCHES`` at most."""
    return max(1, -(-len(_log_files(_files(spark, path)[1])) // LOG_BATCHES))


def _log_files(found: list) -> list:
    return [s for s in found if s.getPath().getName().startswith("part-")]


def _fill(spark: SparkSession, path: str) -> None:
    """Empty files behind the log's, so that its last micro-batch takes none of the tail."""
    fs, found = _files(spark, path)
    per = batch_files(spark, path)
    for i in range(-len(_log_files(found)) % per):
        fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/part-x{i:05d}.json")).close()


def _files(spark: SparkSession, path: str) -> tuple:
    """The file system of a folder, and the status of its data files by name."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s for s in fs.listStatus(folder) if s.getPath().getName().startswith(("part-", "tail-"))]
    return fs, sorted(found, key=lambda s: s.getPath().getName())


def _move(spark: SparkSession, source: str, path: str) -> None:
    """Move the files of ``source`` behind those of ``path`` (by name)."""
    fs, found = _files(spark, source)
    _, there = _files(spark, path)
    n = sum(s.getPath().getName().startswith("tail-") for s in there)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for i, s in enumerate(found):
        _, kind = s.getPath().getName().split(".", 1)        # the reader tells compression by it
        fs.rename(s.getPath(), target(f"{path}/tail-{n + i:05d}.{kind}"))
    fs.delete(target(source), True)


def _in_order(spark: SparkSession, path: str) -> None:
    """Give the files of a feed modification times in the order of their names."""
    fs, found = _files(spark, path)
    last = max((s.getModificationTime() for s in found), default=0)
    for i, s in enumerate(reversed(found)):
        fs.setTimes(s.getPath(), last - i * 1000, -1)


@contextlib.contextmanager
def state_partitions(spark: SparkSession, n: int | None = None, stream: DataFrame | None = None):
    """Number of state partitions for streams started inside the block.

    A stream fixes its state partitions (``spark.sql.shuffle.partitions``) at its
    first batch, for the life of its checkpoint, from the session copy taken when
    it starts. ``None`` keeps the session's value. With a ``stream`` that uses state variables and
    timers its state goes to RocksDB, which they need. The settings are restored.
    """
    values = {}
    if stream is not None and "TransformWithState" in stream._jdf.queryExecution().analyzed().toString():
        values[STATE_STORE] = ROCKSDB
    if n is not None:
        values["spark.sql.shuffle.partitions"] = str(n)
    with settings(spark, values):
        yield


def replay_partitions(spark: SparkSession) -> int:
    """State partitions of a replayed log: a partition per core, which is what a replay can use."""
    return spark.sparkContext.defaultParallelism


@contextlib.contextmanager
def replaying(spark: SparkSession):
    """Settings of streams started inside the block that replay feeds: a task takes few compressed
    files, and what a micro-batch exchanged goes with it."""
    with settings(spark, {"spark.sql.files.maxPartitionBytes": FILE_BYTES, SHUFFLE_CLEANUP: "true"}):
        yield


def run_to_end(query) -> None:
    """Wait, without a limit, for an ``availableNow`` query to end; raise if it failed."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def feed_path(folder: str, name: str = "log") -> str:
    """Where a run's feed is."""
    return f"{folder}/feeds/{name}"


def replay(spark: SparkSession, folder: str, start: Callable) -> None:
    """Run the query that ``start`` starts to the end of the feeds in ``folder``. They have then been
    taken whole and go, with the checkpoint, which is of no use without them; what failed stays.

    A task takes few compressed files, and what a micro-batch exchanged goes with it.
    """
    with settings(spark, {"spark.sql.files.maxPartitionBytes": FILE_BYTES, SHUFFLE_CLEANUP: "true"} | STATE_ON_DISK):
        query = start()
    run_to_end(query)
    for path in (f"{folder}/feeds", f"{folder}/checkpoint"):
        drop(spark, path)


def drain_to_parquet(stream: DataFrame, folder: str, output_mode: str = "append",
                     partitions: int | None = None) -> DataFrame:
    """Run ``stream`` over everything available into Parquet; return what it wrote."""
    spark = stream.sparkSession
    writer = (stream.writeStream.outputMode(output_mode).format("parquet").option("path", f"{folder}/data")
              .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True))
    with state_partitions(spark, partitions or replay_partitions(spark), stream):
        replay(spark, folder, writer.start)
    return spark.read.schema(stream.schema).parquet(f"{folder}/data")


def drain_to_outputs(stream: DataFrame, folder: str, tag: str = "outcome") -> Outputs:
    """Run ``stream`` over everything available into main and side outputs (K6)."""
    outputs = Outputs(stream.sparkSession, folder, tag)
    spark = stream.sparkSession
    with state_partitions(spark, replay_partitions(spark), stream):
        replay(spark, folder, outputs.writer(stream, f"{folder}/checkpoint").trigger(availableNow=True).start)
    return outputs
