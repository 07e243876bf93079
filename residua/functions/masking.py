"""Masked-language-model corruption as column expressions."""

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vocabulary import ESM2, Vocabulary

# Fixed value: the label of a position that does not enter the loss.
IGNORED = -100

# Of the chosen positions, 8 in 10 become the mask token, 1 in 10
# a random token, and the rest stay.
MASK_SHARE = Fraction(8, 10)
RANDOM_SHARE = Fraction(1, 10)


def _bound(share: Fraction) -> Column:
    """Draws below this are ``share`` of all signed 64-bit numbers."""
    return F.lit(min(int(share * 2**64) - 2**63, 2**63 - 1))


def replacements(
    ids: Column,
    seed: int,
    epoch: Column,
    row_id: Column,
    probability: Fraction,
    vocab: Vocabulary = ESM2,
) -> Column:
    """Per position what it becomes if it is chosen, else NULL; special tokens never are.

    A position draws a 64-bit hash of seed, epoch, row and position. Its size chooses
    the position and the action, its middle bits are the random token. The commonest
    outcome is tested first, for a lambda is interpreted node by node.
    """
    seed, epoch = F.lit(seed).cast("bigint"), epoch.cast("bigint")
    nothing = F.lit(None).cast("int")

    def replacement(x, i):
        draw = F.xxhash64(seed, epoch, row_id, i)
        other = F.shiftrightunsigned(draw, 8) % F.lit(len(vocab.symbols))
        return (
            F.when(draw >= _bound(probability), nothing)
            .when(x.isin(vocab.special_ids), nothing)
            .when(draw < _bound(probability * MASK_SHARE), F.lit(vocab.mask_id))
            .when(draw < _bound(probability * (MASK_SHARE + RANDOM_SHARE)), other.cast("int"))
            .otherwise(x)
        )

    return F.transform(ids, replacement)


# Both arrays are arguments of ``zip_with``: an array that a lambda looks into from
# outside could be inlined by the optimiser and be computed again for every element.


def mlm_labels(ids: Column, replaced: Column) -> Column:
    """The id where a position is chosen, else ``IGNORED``."""
    return F.zip_with(ids, replaced, lambda x, r: F.when(r.isNull(), IGNORED).otherwise(x))


def mlm_inputs(ids: Column, replaced: Column) -> Column:
    """The ids with the chosen positions replaced."""
    return F.zip_with(ids, replaced, lambda x, r: F.coalesce(r, x))
