"""FASTA files to tokenised shards and their index maps."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vocabulary import ESM2, Vocabulary
from ..operators.index import index_map, write_index_map
from ..operators.split import hash_split, spread, write_sequences_csv, write_shards
from ..operators.tokenize import tokenize
from ..sources import read_fasta, read_shards

SPLITS = ("train", "test")


def fasta_to_sequences(
    spark: SparkSession,
    fasta: str,
    out: str,
    as_csv: bool = False,
    mode: str = "errorifexists",
    partitions: int | None = None,
) -> None:
    """Records of FASTA files as a table; Parquet unless CSV is asked for.

    ``partitions`` spreads the records, for gzip input.
    """
    records = read_fasta(spark, fasta, partitions)
    if as_csv:
        write_sequences_csv(records, out, mode)
    else:
        records.write.mode(mode).parquet(out)


def tokenised_splits(
    sequences: DataFrame,
    max_length: int,
    tasks: int | None = None,
    train: float = 0.8,
    seed: int = 42,
    vocab: Vocabulary = ESM2,
) -> DataFrame:
    """``sequence_id, split, input_ids, attention_mask``.

    Spreads the sequences as text, about an eighth of the bytes of their id arrays, and
    tokenises after that shuffle.
    """
    sequences = spread(hash_split(sequences, "sequence_id", train, seed), tasks)
    return tokenize(sequences, max_length, vocab).select(
        "sequence_id", "split", "input_ids", "attention_mask"
    )


def write_corpus(
    sequences: DataFrame,
    out: str,
    max_length: int,
    tasks: int | None = None,
    rows_per_file: int | None = None,
    train: float = 0.8,
    seed: int = 42,
    vocab: Vocabulary = ESM2,
    mode: str = "errorifexists",
) -> None:
    """Train and test shards in one pass over the sequences, as ``split=…`` directories."""
    rows = tokenised_splits(sequences, max_length, tasks, train, seed, vocab)
    write_shards(rows, out, rows_per_file=rows_per_file, by_split=True, mode=mode)


def write_corpus_in_files(
    sequences: DataFrame,
    out: str,
    max_length: int,
    files: dict[str, int],
    train: float = 0.8,
    seed: int = 42,
    vocab: Vocabulary = ESM2,
    mode: str = "errorifexists",
) -> None:
    """Same shards with an exact file count per split, one pass for each.

    Both splits need a count. A pass reads the sequences again but tokenises its own rows only.
    """
    if set(files) != set(SPLITS):
        raise ValueError(f"a file count is needed for each of {SPLITS}, got {sorted(files)}")
    split = hash_split(sequences, "sequence_id", train, seed)
    for name, count in files.items():
        part = spread(split.where(F.col("split") == name), count)
        rows = tokenize(part, max_length, vocab)
        rows = rows.select("sequence_id", "input_ids", "attention_mask")
        write_shards(rows, f"{out}/split={name}", mode=mode)


def write_index_maps(spark: SparkSession, corpus: str, out: str, mode: str = "errorifexists") -> None:
    """One map per split, beside the corpus: ``{out}/train_index_map`` and so on."""
    for name in SPLITS:
        shards = read_shards(spark, f"{corpus}/split={name}", columns=[])
        write_index_map(index_map(shards), f"{out}/{name}_index_map", mode)
