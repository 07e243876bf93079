"""Shards that carry their own row numbers, and lookups that open only the shards they need.

Rows with a dense number lie in blocks of a fixed size, one file a block, in the order of
their numbers. The directories say which block a file holds and how large blocks are
(``rows=1000/block=7``), so a row's number is a projection over its place on disk: no map is
joined. A lookup joins on the block as well, which is a partition column, so Spark prunes the
files at run time to the blocks that are asked for.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .lookup import _finish

# Partition columns of the layout.
ROWS, BLOCK = "rows", "block"


def block_of(number: Column, rows_per_block: int) -> Column:
    return F.floor(number / rows_per_block).cast("bigint")


def write_numbered(
    rows: DataFrame,
    path: str,
    rows_per_block: int,
    id_col: str = "global_idx",
    tasks: int | None = None,
    mode: str = "errorifexists",
) -> None:
    """One file per block of ``rows_per_block`` rows; ``id_col`` is dense and unique from 0.

    The number says which task a row goes to, so there is no sampling pass and tasks get equal
    shares. Numbers with gaps or copies, or null, fail the job before anything is written.
    """
    number = F.col(id_col).cast("bigint")
    low, high, n, ids = rows.agg(F.min(number), F.max(number), F.count("*"), F.count_distinct(number)).first()
    if n and (low, high, ids) != (0, n - 1, n):
        raise ValueError(f"{id_col} is not dense and unique from 0: {n} rows, {ids} numbers from {low} to {high}")
    blocks = -(-n // rows_per_block) or 1
    tasks = min(tasks or rows.sparkSession.sparkContext.defaultParallelism, blocks)
    placed = rows.withColumn(BLOCK, block_of(number, rows_per_block))
    dealt = placed.repartitionById(tasks, F.floor(F.col(BLOCK) * tasks / blocks).cast("int"))
    ordered = dealt.sortWithinPartitions(BLOCK, id_col).withColumn(ROWS, F.lit(rows_per_block).cast("bigint"))
    ordered.drop(id_col).write.mode(mode).partitionBy(ROWS, BLOCK).parquet(path)


def read_numbered(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """The rows with ``global_idx`` and ``block``, from the directories and places on disk."""
    shards = spark.read.parquet(path)
    stored = [c for c in shards.columns if c not in (ROWS, BLOCK)]
    number = F.col(BLOCK).cast("bigint") * F.col(ROWS).cast("bigint") + F.col("_metadata.row_index")
    return shards.select(
        *(columns if columns is not None else stored), F.col(BLOCK).cast("bigint").alias(BLOCK),
        number.alias("global_idx"),
    )


def rows_per_block_of(spark: SparkSession, path: str) -> int:
    """The block size of a folder, from the name of its directory."""
    sizes = [r[0] for r in spark.read.parquet(path).select(F.col(ROWS).cast("bigint")).distinct().collect()]
    if len(sizes) != 1:
        raise ValueError(f"{path!r} holds blocks of {len(sizes)} sizes, not of one")
    return sizes[0]


def lookup_numbered(
    requests: DataFrame, numbered: DataFrame, rows_per_block: int, idx_col: str = "idx", strict: bool = False
) -> DataFrame:
    """Every request with its sample's columns; only blocks that are asked for are opened.

    ``numbered`` comes from ``read_numbered``. While Spark estimates the distinct positions small
    enough to be broadcast (of a table in files it knows), their blocks prune the scan at run time; beyond that Spark joins by shuffles, as
    then most blocks are wanted anyway. A position out of range, negative or null gives NULLs,
    or with ``strict`` fails the job.
    """
    position = F.col(idx_col).cast("bigint")
    asked = requests.select(position.alias("_idx")).where(F.col("_idx") >= 0).distinct()
    asked = asked.withColumn("_block", block_of(F.col("_idx"), rows_per_block))
    sample = [c for c in numbered.columns if c not in (BLOCK, "global_idx")]
    met = (F.col(BLOCK) == F.col("_block")) & (F.col("global_idx") == F.col("_idx"))
    rows = numbered.join(asked, met).select("_idx", *sample, F.lit(True).alias("_found"))
    joined = requests.join(rows, position == F.col("_idx"), "left").drop("_idx")
    return _finish(joined, requests.columns, sample, idx_col, strict)
