"""Which rank reads which row in which batch of an epoch."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import HASH_BITS, hash_key, seeded_hash, with_bijection

# 2**16 hash buckets: the offsets are at most that many rows however big the data.
# Past about 10**9 rows take more bits; 2**20 rows are the most that are broadcast.
BUCKET_BITS = 16
MOST_BUCKET_BITS = 20


def _with_position(df: DataFrame, key, id_col: str, bucket) -> DataFrame:
    """Adds ``pos``, the dense rank by (key, id), and ``_rows``, the row count.

    Rows are numbered within buckets of the key; a bucket's offset is the count of the
    buckets before it. The buckets depend on the data alone, so a lost task that runs
    again numbers its rows the same way and nothing has to be persisted between.
    """
    keyed = df.withColumn("_key", key).withColumn("_bucket", bucket)
    counts = keyed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = counts.select(
        "_bucket",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(everything).alias("_rows"),
    )
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key", id_col))
    return (
        keyed.withColumn("_within", within)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn("pos", F.col("_offset") + F.col("_within") - 1)
        .drop("_key", "_bucket", "_offset", "_within")
    )


def permutation(
    df: DataFrame, id_col: str, seed: int, epoch: int, bucket_bits: int = BUCKET_BITS
) -> DataFrame:
    """Adds ``pos``, a shuffle of the rows that is a function of seed, epoch and id, and
    ``_rows``, how many there are.

    Unique ids fill the buckets evenly. The number of buckets has no effect on ``pos``.
    """
    if not 0 <= bucket_bits <= MOST_BUCKET_BITS:
        raise ValueError(f"bucket_bits must be in 0..{MOST_BUCKET_BITS}, got {bucket_bits}")
    key = seeded_hash(seed + epoch, hash_key(df, id_col))
    bucket = F.shiftright("_key", HASH_BITS - bucket_bits)
    return _with_position(df, key, id_col, bucket)


def _by_id(df: DataFrame, id_col: str) -> DataFrame:
    """Adds ``pos`` in id order and ``_rows``; the ids are checked to be dense and unique."""
    number = F.col(id_col).cast("bigint")
    facts = df.agg(F.struct(
        F.min(number).alias("low"), F.max(number).alias("high"), F.count("*").alias("rows"),
        F.count_distinct(number).alias("ids"),
    )).scalar()
    low, high, rows, ids = (facts.getField(name) for name in ("low", "high", "rows", "ids"))
    dense = (ids == rows) & (high - low + 1 == rows)
    message = F.lit(f"{id_col} is not dense and unique")
    checked = F.when(dense, number - low).otherwise(F.raise_error(message).cast("bigint"))
    return df.withColumn("pos", checked).withColumn("_rows", rows)


def epoch_assignment(
    df: DataFrame,
    world_size: int,
    batch_size: int,
    seed: int = 0,
    epoch: int = 0,
    shuffle: bool = True,
    id_col: str = "id",
    bucket_bits: int = BUCKET_BITS,
) -> DataFrame:
    """Adds ``pos, rank, rank_pos, batch``; the other columns travel along.

    ``id_col`` is unique; with ``shuffle=False`` it is also dense, like ``global_idx``, and
    its distance from the least id becomes the position. Ids with gaps or copies fail the
    job. Rows are repeated from the beginning until every rank has the same number.
    """
    if shuffle:
        placed = permutation(df, id_col, seed, epoch, bucket_bits)
    else:
        placed = _by_id(df, id_col)
    return _dealt(placed, world_size, batch_size)


def bijective_assignment(
    df: DataFrame,
    world_size: int,
    batch_size: int,
    seed: int = 0,
    epoch: int = 0,
    id_col: str = "global_idx",
    rows: int | Column | None = None,
) -> DataFrame:
    """The columns of ``epoch_assignment`` without a shuffle, for rows numbered from 0.

    ``id_col`` is dense and unique from 0, like ``global_idx``; its place is a keyed bijection
    of ``[0, rows)``, so position, rank and batch are projections. ``rows`` is counted where it
    is not given (the index map has it); a number beyond it fails the job. The order differs
    from that of ``epoch_assignment``.
    """
    if rows is None:
        rows = df.agg(F.count("*").alias("rows")).scalar()
    n = rows if isinstance(rows, Column) else F.lit(rows)
    number = df.withColumn("_number", F.col(id_col).cast("bigint")).withColumn("_rows", n.cast("bigint"))
    placed = with_bijection(number, "_number", F.col("_rows"), seed, epoch, "pos").drop("_number")
    return _dealt(placed, world_size, batch_size)


def _dealt(placed: DataFrame, world_size: int, batch_size: int) -> DataFrame:
    """From ``pos`` of ``_rows`` to rank and batch; the first rows are repeated at the end."""
    rounds = F.ceil(F.col("_rows") / world_size)
    positions = F.sequence(F.col("pos"), rounds * world_size - 1, F.col("_rows"))
    return (
        placed.withColumn("pos", F.explode(positions))
        .drop("_rows")
        .withColumn("rank", (F.col("pos") % world_size).cast("int"))
        .withColumn("rank_pos", F.floor(F.col("pos") / world_size).cast("bigint"))
        .withColumn("batch", F.floor(F.col("rank_pos") / batch_size).cast("bigint"))
    )


def packed_batches(assigned: DataFrame, columns, keys=None) -> DataFrame:
    """One row per batch with its samples in order; a batch holds ``batch_size`` rows.

    ``keys`` default to rank and batch, and the epoch if there is one.
    """
    if keys is None:
        keys = [*(["epoch"] if "epoch" in assigned.columns else []), "rank", "batch"]
    sample = F.struct("rank_pos", *columns)
    rows = F.sort_array(F.collect_list(sample))
    return assigned.groupBy(*keys).agg(rows.alias("samples"))


def batches_per_rank(assigned: DataFrame, keys=("rank",)) -> DataFrame:
    """``num_batches`` per rank; batches are numbered from 0 without gaps."""
    return assigned.groupBy(*keys).agg((F.max("batch") + 1).alias("num_batches"))
