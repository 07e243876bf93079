"""From raw documents to packed training sequences, one operator a stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept. All
but the last return the columns of ``documents``, and further columns if the input has any. A
stage's rows are computed when they are written, so the size of the batches that it hands to
Python is set for the session and stays set.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residua.llm.chosen_path import BATCH, without_near_duplicates
from residua.llm.packing import pack
from residua.llm.quality import FOLD, FOLDS, THRESHOLD, fit, score
from residua.llm.language import hold_out
from residua.llm.queries import QUERY_KEY, table
from residua.llm.substrings import without_repeats
from residua.llm.surrogates import without_personal_data
from residua.plans.workspace import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage with ``BATCH`` set: whole texts are held several times over by both sides of a hand-over."""

    @wraps(stage)
    def set_before(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for key, value in BATCH.items():
            spark.conf.set(key, value)
        return stage(spark, docs, sf_dir)

    return set_before


@in_small_batches
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled ones."""
    model = fit(docs.where(~hold_out(F.col("doc_id"), FOLDS, FOLD)), table(spark, sf_dir, "labels"))
    return docs.where(score(F.col("text"), model) >= THRESHOLD)


@in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; links are from a similarity of 0.85, as in op4."""
    return without_near_duplicates(docs)


@in_small_batches
def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur more than once in what is left."""
    return without_repeats(docs)


@in_small_batches
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data."""
    return without_personal_data(docs, QUERY_KEY)


@in_small_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("personal_data", personal_data),
    ("packing", packing),
]

# No stage but the shingles and windows can be expressed in SQL; tests/llm checks each stage
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
