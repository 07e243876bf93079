"""Sample access by position or by key, for whole sets of requests at once."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sizes of files as powers of two; a file's level is the power that it reaches.
_MOST_LEVEL = 62


def with_global_index(shards: DataFrame, index: DataFrame) -> DataFrame:
    """Adds ``global_idx``, dense over all shards; needs ``file_name, row_index``.

    The map has one row per file; Spark sends it to the rows while it is small.
    """
    starts = index.select("file_name", "start_line")
    joined = shards.join(starts, "file_name")
    return joined.withColumn("global_idx", F.col("start_line") + F.col("row_index")).drop(
        "start_line"
    )


def _level(rows: Column) -> Column:
    return F.least(F.floor(F.log2(rows.cast("double"))).cast("int"), F.lit(_MOST_LEVEL))


def spots(positions: DataFrame, index: DataFrame, idx_col: str = "idx") -> DataFrame:
    """``idx, file_name, local_row`` of distinct positions that some file holds.

    Files of 2**k to 2**(k+1) - 1 rows meet the positions in bins of 2**k, so a bin overlaps
    three of them at most, however uneven the files are. A position is looked for once per
    level that occurs.
    """
    files = index.where("num_sequences > 0").withColumn("_level", _level(F.col("num_sequences")))
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_level"))
    first, last = (F.floor(F.col(c) / size).cast("bigint") for c in ("start_line", "end_line"))
    ranges = files.select(
        "file_name", "start_line", "end_line", "_level", F.explode(F.sequence(first, last)).alias("_bin")
    )
    levels = files.agg(F.collect_set("_level")).scalar()
    asked = positions.withColumn("_level", F.explode(levels))
    asked = asked.withColumn("_bin", F.floor(F.col(idx_col) / size).cast("bigint"))
    inside = (F.col("start_line") <= F.col(idx_col)) & (F.col("end_line") >= F.col(idx_col))
    row = (F.col(idx_col) - F.col("start_line")).alias("local_row")
    return asked.join(ranges, ["_level", "_bin"]).where(inside).select(idx_col, "file_name", row)


def _positions(requests: DataFrame, idx_col: str) -> DataFrame:
    return requests.select(F.col(idx_col).cast("bigint").alias(idx_col)).where(F.col(idx_col).isNotNull()).distinct()


def locate(requests: DataFrame, index: DataFrame, idx_col: str = "idx") -> DataFrame:
    """Adds ``file_name`` and ``local_row``; both NULL for a position out of range.

    Distinct positions meet the ranges; a position that many requests share is split by
    adaptive execution where the requests come back.
    """
    found = spots(_positions(requests, idx_col), index, idx_col)
    return requests.join(found, idx_col, "left").select(*requests.columns, "file_name", "local_row")


def _required(column: str, key: str) -> Column:
    message = F.concat(F.lit("no sample for "), F.col(key).cast("string"))
    missing = F.col("_found").isNull()
    return F.when(missing, F.raise_error(message)).otherwise(F.col(column)).alias(column)


def _finish(joined: DataFrame, requests, samples, key: str, strict: bool) -> DataFrame:
    kept = [c for c in samples if c not in requests]
    if not strict:
        return joined.select(*requests, *kept)
    return joined.select(*requests, *[_required(c, key) for c in kept])


def lookup_positions(
    requests: DataFrame,
    index: DataFrame,
    shards: DataFrame,
    strategy: str = "dense",
    idx_col: str = "idx",
    strict: bool = False,
) -> DataFrame:
    """Every request with its sample's columns.

    ``dense`` numbers all rows and joins on the number: for requests that touch much
    of the data. ``binned`` first resolves the distinct positions to file and row, and only
    the rows that are asked for go on. No job runs while the plan is built. A position out
    of range gives NULLs, or with ``strict`` fails the job.
    """
    sample = [c for c in shards.columns if c not in ("file_name", "row_index")]
    if strategy == "dense":
        rows = with_global_index(shards, index).withColumnRenamed("global_idx", idx_col)
    elif strategy == "binned":
        wanted = spots(_positions(requests, idx_col), index, idx_col)
        rows = shards.withColumnRenamed("row_index", "local_row").join(wanted, ["file_name", "local_row"])
    else:
        raise ValueError(f"strategy must be 'dense' or 'binned', got {strategy!r}")
    rows = rows.select(idx_col, *sample, F.lit(True).alias("_found"))
    joined = requests.join(rows, idx_col, "left")
    return _finish(joined, requests.columns, sample, idx_col, strict)


def lookup_keys(
    requests: DataFrame,
    items: DataFrame,
    key: str = "sequence_id",
    strict: bool = False,
    unique: bool = True,
) -> DataFrame:
    """Every request with the item stored under its key; items bucketed by key stay put.

    The store holds one item a key. With ``unique`` that is taken as given; otherwise of items
    that share a key the least by all columns is kept.
    """
    if not unique:
        rest = [c for c in items.columns if c != key]
        items = items.groupBy(key).agg(F.min(F.struct(*rest)).alias("_item")).select(key, "_item.*")
    rows = items.withColumn("_found", F.lit(True))
    joined = requests.join(rows, key, "left")
    return _finish(joined, requests.columns, items.columns, key, strict)


def integer_items(items: DataFrame) -> DataFrame:
    """Stored decimal lists as integer arrays."""
    return items.withColumns(
        {c: F.col(c).cast("array<int>") for c in ("input_ids", "attention_mask")}
    )


def model_columns(samples: DataFrame) -> DataFrame:
    return samples.select("input_ids", "attention_mask")
