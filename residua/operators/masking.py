"""Masked-language-model inputs and labels for a table of token arrays."""

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import masking
from ..functions.hashing import hash_key
from ..functions.vocabulary import ESM2, Vocabulary


def mask_tokens(
    df: DataFrame,
    id_col: str,
    probability: float = 0.15,
    seed: int = 0,
    epoch: int | Column = 0,
    vocab: Vocabulary = ESM2,
) -> DataFrame:
    """Replaces ``input_ids`` by the corrupted ids and adds ``labels``.

    Choices follow from (seed, epoch, id, position). The replacements are a column of
    their own, read by both results, so they are drawn once per row.
    """
    share = Fraction(str(probability))
    epoch = epoch if isinstance(epoch, Column) else F.lit(epoch)
    ids, replaced = F.col("input_ids"), F.col("_replaced")
    drawn = masking.replacements(ids, seed, epoch, hash_key(df, id_col), share, vocab)
    return (
        df.withColumn("_replaced", drawn)
        .withColumns(
            {
                "labels": masking.mlm_labels(ids, replaced),
                "input_ids": masking.mlm_inputs(ids, replaced),
            }
        )
        .drop("_replaced")
    )
