"""Exact dedup by a tree-merge of sorted digest runs (DataFrame functions only).

Every input partition first reduces its own rows to one run of ``(digest, smallest id,
count)``. Runs are then exchanged in binomial rounds: ``fan_in`` neighbouring runs (three binomial
levels at a time for 8) meet, sorted by digest and identifier; of equal neighbours the first, with
the smallest identifier, stays and takes their counts, until one run is left. A merge is
keyed by (run, digest), so a round is dealt over all tasks, and a digest that holds a third of
all rows enters a round as at most one row per run. Entries only merge when the SHA-256, the
length and a second, independent 64-bit hash of the normalised text all agree (the verification).

Defined results: a null text counts as empty; texts are equal when identical
after every run of ``[\\x20\\x09-\\x0D]`` becomes one space; of equal texts the
smallest identifier stays (null identifiers only if the group has no other).
Rows repeating both identifier and text are one row to ``mark`` (each is
reported, with the same flags, and counted) and ``keep_first`` returns one of
them. An empty table gives an empty result. Extra columns pass through
``keep_first`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import join_hot, written

WHITE = r"[\x20\x09-\x0D]+"
_KEY = ("digest", "chars", "second")


def normalised(text: Column) -> Column:
    """Text with null as empty and white-space runs as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm = normalised(F.col(text_col))
    return (docs.select(F.col(id_col).alias("id"), norm.alias("norm"))
            .select("id", F.unhex(F.sha2("norm", 256)).alias("digest"),
                    F.length("norm").alias("chars"), F.xxhash64("norm").alias("second")))


def merge_runs(keyed: DataFrame, runs: int = 512, fan_in: int = 8) -> DataFrame:
    """Tree-merge ``(id, digest, chars, second)`` rows into one run of groups."""
    step = (keyed.withColumn("run", F.spark_partition_id() % F.lit(runs))
            .groupBy("run", *_KEY).agg(F.min("id").alias("keep_id"),
                                       F.count(F.lit(1)).alias("group_size")))
    while runs > 1:
        runs = -(-runs // fan_in)
        step = step.withColumn("run", F.floor(F.col("run") / F.lit(fan_in)).cast("int"))
        sorted_run = Window.partitionBy("run", *_KEY).orderBy(F.col("keep_id").asc_nulls_last())
        equal = sorted_run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        step = (step.withColumn("at", F.row_number().over(sorted_run))
                .withColumn("group_size", F.sum("group_size").over(equal)).where("at = 1").drop("at"))
    return step.drop("run")


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         runs: int = 512, fan_in: int = 8) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    The keyed rows (identifier and digests, no text) are written once and used
    for the runs and for handing the verdicts back. That join is on the digest; the rows
    of a hot digest are dealt to several tasks.
    """
    keyed = written(_keyed(docs, id_col, text_col))
    groups = written(merge_runs(keyed, runs, fan_in))
    return (join_hot(keyed.withColumn("spread", F.monotonically_increasing_id()), groups, list(_KEY),
                     "group_size", "spread")
            .select(F.col("id").alias("doc_id"), "keep_id", "group_size",
                    F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               runs: int = 512, fan_in: int = 8) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. The semi-join and the
    choice among fully repeated rows share one exchange on (identifier, digest)."""
    stay = (mark(docs, id_col, text_col, runs, fan_in).where("kept")
            .select(F.col("doc_id").cast("string").alias("__id"),
                    F.col("text_sha256").alias("__sha"))
            .fillna({"__id": ""}))
    rows = (docs.withColumn("__id", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
            .withColumn("__sha", F.sha2(normalised(F.col(f"`{text_col}`")), 256))
            .join(stay, ["__id", "__sha"], "left_semi"))
    same = Window.partitionBy("__id", "__sha").orderBy(*[F.col(f"`{c}`") for c in docs.columns])
    return (rows.withColumn("__n", F.row_number().over(same)).where("__n = 1")
            .drop("__id", "__sha", "__n"))
