"""Reproducible train/test split and the shard writers."""

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import HASH_BITS, hash_key, seeded_hash
from ..plans.workspace import session_settings


def split_threshold(train: float) -> int:
    """Hashes below it are on the train side: the share of the whole range."""
    return int(Fraction(str(train)) * 2**HASH_BITS)


def hash_split(
    df: DataFrame, key: str, train: float = 0.8, seed: int = 42, hash: str = "xxhash64"
) -> DataFrame:
    """Adds ``split``, 'train' or 'test', from the seed and the key alone.

    Independent of partitioning and row order, and a projection: no sort, no shuffle.
    Rows with the same key land on the same side.
    """
    place = seeded_hash(seed, hash_key(df, key), name=hash)
    side = F.when(place < split_threshold(train), "train").otherwise("test")
    return df.withColumn("split", side)


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int | None = None) -> list[DataFrame]:
    """Per-row split. Depends on the partitioning and sorts every partition."""
    return df.randomSplit(list(weights), seed)


def spread(df: DataFrame, files: int | None, order_by: str | None = None) -> DataFrame:
    """Over ``files`` tasks: by ranges of a column, or evenly whatever the keys are."""
    if files is None:
        return df
    if order_by is None:
        return df.repartition(files)
    return df.repartitionByRange(files, order_by).sortWithinPartitions(order_by)


def spread_by_id(df: DataFrame, id_col: str, rows_per_file: int) -> DataFrame:
    """Over tasks of exactly ``rows_per_file`` rows in id order; ids are dense from 0.

    The id says which file a row belongs to, so there is no sampling pass and a hot
    range cannot arise.
    """
    last = df.agg(F.max(id_col)).first()[0]
    files = 1 if last is None else last // rows_per_file + 1
    file_no = F.floor(F.col(id_col) / rows_per_file).cast("int")
    return df.repartitionById(files, file_no).sortWithinPartitions(id_col)


def files_for(df: DataFrame, rows_per_file: int) -> int:
    """How many files hold about ``rows_per_file`` rows each, whatever the ids are.

    Counts the rows; columns are not read.
    """
    return max(1, -(-df.count() // rows_per_file))


def write_shards(
    df: DataFrame,
    path: str,
    files: int | None = None,
    rows_per_file: int | None = None,
    order_by: str | None = None,
    by_split: bool = False,
    mode: str = "errorifexists",
) -> None:
    """Parquet shards.

    ``files`` repartitions to that many tasks, ``rows_per_file`` caps every file
    without a shuffle, ``order_by`` makes file order the order of that column, and
    ``by_split`` writes one directory per value of ``split`` in a single pass.
    """
    writer = spread(df, files, order_by).write.mode(mode)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if by_split:
        writer = writer.partitionBy("split")
    writer.parquet(path)


def write_shards_of_size(
    df: DataFrame,
    path: str,
    target_bytes: int,
    shuffle_ratio: float = 1.0,
    keys=(),
    by_split: bool = False,
    mode: str = "errorifexists",
) -> None:
    """Parquet shards of about ``target_bytes`` each, without a pass that counts rows.

    Adaptive execution knows the bytes of every partition once they are shuffled: it merges
    small ones and splits large ones, also those of a hot key, up to an advisory size.
    ``shuffle_ratio`` is how many shuffled bytes make a byte of file, as ``measured_ratio`` of
    an earlier write tells; ``keys`` bring rows together. While this runs, the session's
    settings for that shuffle are set, so other writes should not start in the same session.
    """
    spark = df.sparkSession
    advisory = max(1, round(target_bytes * shuffle_ratio))
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(max(1, advisory // 2)),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory),
    }
    with session_settings(spark, settings):
        write_shards(df.hint("rebalance", *keys), path, by_split=by_split, mode=mode)


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``file_name, bytes`` of the Parquet files below ``path``, from a listing."""
    options = {"pathGlobFilter": "*.parquet", "recursiveFileLookup": True}
    files = spark.read.format("binaryFile").options(**options).load(path)
    return files.select(F.col("path").alias("file_name"), F.col("length").alias("bytes"))


def measured_ratio(spark: SparkSession, path: str, target_bytes: int, shuffle_ratio: float = 1.0) -> float:
    """The ratio that would have met the target, from the median file of an earlier write."""
    typical = file_sizes(spark, path).agg(F.median("bytes").alias("m")).first().m
    return shuffle_ratio * target_bytes / typical if typical else shuffle_ratio


def write_sequences_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.select("sequence", "sequence_id").write.mode(mode).options(**options).csv(path)
