"""Corpus pipeline: from raw documents to encoded training text.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and
read again as the next stage's ``docs``. All but the last return the columns of
``documents``; a stage sees all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercato.llm import decontaminate, exact_dedup, jaccard, quality, sentencepiece
from mercato.llm.common import read, written
from mercato.llm.queries import tokenizer_file


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more stay."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, out_col="__score")
    return scored.where("__score >= 0.3").drop("__score")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest identifier stays."""
    return exact_dedup.keep_first(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more over shingles of
    five words, the one with the smallest identifier stays."""
    return jaccard.keep_one(docs, size=5, threshold=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of ten benchmark words go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every text that is left, next to the document's columns."""
    return sentencepiece.encode(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("SentencePiece encoding", encode_stage),
]

# The first stage is a trained classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, applied to ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
