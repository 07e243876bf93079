"""The keyed item store as a table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import KEYED_ITEMS


def as_items(samples: DataFrame, key: str) -> DataFrame:
    """Samples in the store's form: integer key, decimal lists."""
    types = {f.name: f.dataType for f in KEYED_ITEMS}
    return samples.select(
        F.col(key).cast("bigint").alias("sequence_id"),
        *[F.col(c).cast(types[c]).alias(c) for c in ("input_ids", "attention_mask")],
    )


def write_items(items: DataFrame, path: str, mode: str = "errorifexists") -> None:
    items.write.mode(mode).parquet(path)


def write_bucketed_items(
    items: DataFrame, table: str, path: str, buckets: int, mode: str = "errorifexists"
) -> None:
    """As a table bucketed by key: lookups by key then leave the items where they lie.

    One task per bucket writes it, so there are ``buckets`` files.
    """
    (
        items.repartition(buckets, "sequence_id")
        .write.mode(mode)
        .bucketBy(buckets, "sequence_id")
        .sortBy("sequence_id")
        .option("path", path)
        .saveAsTable(table)
    )


# Keys of one pruned read; they are literals of the plan.
MOST_KEYS = 10_000


def items_of_keys(items: DataFrame, keys: DataFrame, key: str = "sequence_id", most: int = MOST_KEYS) -> DataFrame:
    """The stored items of a few keys; of a bucketed table only the buckets of those keys are read.

    The distinct keys go into the plan, where Spark prunes the buckets by them. More than ``most``
    are an error: join them with ``lookup_keys``, which leaves the items where they lie.
    """
    found = keys.select(F.col(key).cast("bigint").alias(key)).where(F.col(key).isNotNull()).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} keys; use lookup_keys")
    return items.where(F.col(key).isin([row[0] for row in found]))
