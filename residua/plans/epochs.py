"""Training-ready epochs: shuffled, assigned to ranks, masked and laid out by rank."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tokens import mask_of_length, real_length
from ..functions.vocabulary import ESM2, Vocabulary
from ..operators.masking import mask_tokens
from ..operators.sampler import bijective_assignment, epoch_assignment


def epoch_samples(
    samples: DataFrame,
    world_size: int,
    batch_size: int,
    seed: int = 0,
    epoch: int = 0,
    id_col: str = "global_idx",
    probability: float = 0.15,
    vocab: Vocabulary = ESM2,
    batches_per_file: int | None = None,
    tasks: int | None = None,
    shuffle: bool = True,
    order: str = "hash",
    rows: int | Column | None = None,
) -> DataFrame:
    """Every sample of the epoch with rank, batch, corrupted ids, mask and labels.

    ``order`` is how rows are shuffled: ``hash`` for any unique id, ``bijection`` for rows
    numbered from 0 (``rows`` of them), which gets by without a shuffle of its own: only the
    layout moves the token arrays.

    Only the id, the token ids and the real length go through the shuffles; the attention
    mask, as long as the ids, follows from the length, and masking runs on the far side. With
    ``tasks`` the rows are dealt by (rank, run of ``batches_per_file`` batches) before that,
    as ``write_epoch`` wants them.
    """
    length = real_length(F.col("attention_mask")).alias("_length")
    narrow = samples.select(id_col, "input_ids", length)
    if order == "bijection":
        placed = bijective_assignment(narrow, world_size, batch_size, seed, epoch, id_col, rows)
    elif order == "hash":
        placed = epoch_assignment(narrow, world_size, batch_size, seed, epoch, shuffle, id_col=id_col)
    else:
        raise ValueError(f"order must be 'hash' or 'bijection', got {order!r}")
    if tasks:
        run = F.floor(F.col("batch") / batches_per_file)
        placed = placed.repartition(tasks, "rank", run).sortWithinPartitions("rank", "batch", "rank_pos")
    mask = mask_of_length(F.col("_length"), F.size("input_ids"))
    rebuilt = placed.withColumn("attention_mask", mask)
    masked = mask_tokens(rebuilt.drop("_length"), id_col, probability, seed, epoch, vocab)
    return masked.withColumn("epoch", F.lit(epoch))


def write_epoch(
    rows: DataFrame, path: str, epoch: int, mode: str = "errorifexists"
) -> None:
    """``epoch=…/rank=…`` directories in batch order, of rows dealt out by ``epoch_samples``.

    A file belongs to one rank and a run of batches, and no rank is the work of a single
    task. An epoch that is there already is an error.
    """
    (
        rows.where(F.col("epoch") == epoch).drop("epoch")
        .write.mode(mode)
        .partitionBy("rank")
        .parquet(f"{path.rstrip('/')}/epoch={epoch}")
    )
