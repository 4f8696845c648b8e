"""Corpus pipeline: five stages over the documents table, each one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; between two
stages the rows are written as Parquet to the shared work folder and read again.  All stages but
the last return the columns of ``documents``.

A stage begins when the rows of the one before have been written, so what that one stored
on its way is deleted then: at any time the work folder holds the scratch of one stage.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm import jaccard_join, mixing, pii, quality, sentencepiece
from sitelens.llm.common import Scratch, stored, table

_SCRATCH = Scratch()


def _stage(function):
    """A stage that deletes the scratch of the stage before and leaves its own to the next."""
    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _SCRATCH.release(spark)
        with _SCRATCH:
            return function(spark, docs, sf_dir)
    return run_stage


@_stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return quality.score(docs, model).where("predicted = 1").select(*docs.columns)


@_stage
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (five words, similarity 0.8 or more)."""
    return jaccard_join.keep_one_per_component(docs, k=5, num=80, den=100)


@_stage
def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind."""
    return pii.redact(docs)


@_stage
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


@_stage
def tokenize_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds SentencePiece ids, their number, and whether they decode to the text."""
    return sentencepiece.encode_with_check(docs, sentencepiece.PieceTable.load())


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("PII", pii_stage),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding and decoding", tokenize_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, "pipeline-" + name.split()[0].lower())
    return docs


#: Model scores, component search and pieces are beyond SQL.
ORACLE_SQL = None
