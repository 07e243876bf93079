"""Sequences to fixed-length token ids and attention masks."""

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tokens
from ..functions.vocabulary import ESM2, Vocabulary


def _check_length(max_length: int) -> None:
    if max_length < 2:
        raise ValueError(f"max_length must leave room for two special tokens, got {max_length}")


def tokenize(
    df: DataFrame, max_length: int, vocab: Vocabulary = ESM2, text_col: str = "sequence"
) -> DataFrame:
    """Adds ``input_ids`` and ``attention_mask``; no Python runs in the tasks.

    The framed ids stay a column of their own between two projections, so that
    they are computed once although both results read them.
    """
    _check_length(max_length)
    ids = tokens.leading_ids(F.col(text_col), max_length - 2, vocab)
    return (
        df.withColumn("_framed", tokens.framed(ids, max_length, vocab))
        .withColumn("input_ids", tokens.padded(F.col("_framed"), max_length, vocab))
        .withColumn("attention_mask", tokens.attention_mask(F.size("_framed"), max_length))
        .drop("_framed")
    )


def tokenize_with(
    df: DataFrame,
    encode: Callable[[str], tuple[list[int], list[int]]],
    text_col: str = "sequence",
) -> DataFrame:
    """Same columns from any Python tokeniser, in Arrow batches.

    ``encode`` maps a text to its ids and its mask and must be picklable. For
    tokenisers that are not a table of letters; ``tokenize`` is the fast way.
    """
    @F.pandas_udf("input_ids array<int>, attention_mask array<int>")
    def encoded(texts: pd.Series) -> pd.DataFrame:
        pairs = [encode(t) for t in texts.fillna("")]
        return pd.DataFrame(pairs, columns=["input_ids", "attention_mask"])

    return df.withColumn("_tokens", encoded(F.col(text_col))).select(
        *df.columns, "_tokens.input_ids", "_tokens.attention_mask"
    )


def token_counts(df: DataFrame) -> DataFrame:
    """Adds ``real_tokens``, the exact count behind the padded length."""
    return df.withColumn("real_tokens", tokens.real_length(F.col("attention_mask")))
