"""The file index map: which global row numbers each shard holds."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.workspace import stored
from ..sources.tables import list_shards, read_files


def rows_per_file(shards: DataFrame, file_col: str = "file_name") -> DataFrame:
    return shards.groupBy(F.col(file_col).alias("file_name")).agg(
        F.count("*").alias("num_sequences")
    )


def index_map(shards: DataFrame, file_col: str = "file_name") -> DataFrame:
    """``file_name, num_sequences, start_line, end_line``, both ends inclusive.

    Rows are counted per file, map side included. The files are then dealt by ranges of their
    names and written with the number of their range; running totals are taken within each
    range, and the totals of the ranges before it, one row per range, are added.
    """
    spark = shards.sparkSession
    ranged = rows_per_file(shards, file_col).repartitionByRange("file_name")
    counted = stored(spark, ranged.withColumn("_range", F.spark_partition_id()), "rows-per-file")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.groupBy("_range").agg(F.sum("num_sequences").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    in_name_order = Window.partitionBy("_range").orderBy("file_name").rowsBetween(Window.unboundedPreceding, 0)
    through = F.col("_offset") + F.sum("num_sequences").over(in_name_order)
    return (
        counted.join(offsets, "_range")
        .withColumn("end_line", through - 1)
        .withColumn("start_line", F.col("end_line") - F.col("num_sequences") + 1)
        .select("file_name", "num_sequences", "start_line", "end_line")
    )


def extended_index_map(spark: SparkSession, known: DataFrame, path: str) -> DataFrame:
    """``known`` and the files below ``path`` that it lacks, numbered behind it in name order.

    The folder is listed, and the listing is held against the map; only files that are new are
    opened, and of them the footers alone. Numbers that were given stay as they are, so the map
    equals a full one where new names sort behind the old ones, as dated folders do. Files of
    the map that are gone are an error. The driver holds the new names, as it holds a listing.
    """
    listed = list_shards(spark, path)
    gone = known.join(listed, "file_name", "left_anti").select("file_name").limit(1).collect()
    if gone:
        raise ValueError(f"a file of the map is gone: {gone[0].file_name}")
    new = [row.path for row in listed.join(known, "file_name", "left_anti").select("path").collect()]
    if not new:
        return known.select(*_MAP)
    counted = index_map(read_files(spark, path, new))
    before = known.agg(F.coalesce(F.max("end_line") + 1, F.lit(0)).alias("_before"))
    moved = counted.join(before).select(
        "file_name", "num_sequences", *[(F.col(c) + F.col("_before")).alias(c) for c in ("start_line", "end_line")]
    )
    return known.select(*_MAP).unionAll(moved)


_MAP = ("file_name", "num_sequences", "start_line", "end_line")


def with_line_num_names(index: DataFrame) -> DataFrame:
    """The same map under the names ``start_line_num`` and ``end_line_num``."""
    return index.withColumnsRenamed(
        {"start_line": "start_line_num", "end_line": "end_line_num"}
    )


def dataset_length(index: DataFrame) -> DataFrame:
    """One row, ``num_rows``."""
    rows = F.coalesce(F.max("end_line") + 1, F.lit(0))
    return index.agg(rows.cast("bigint").alias("num_rows"))


def first_files(index: DataFrame, k: int) -> DataFrame:
    """Map of the first ``k`` whole shards, for a small run."""
    return index.orderBy("start_line").limit(k)


def write_index_map(
    index: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False
) -> None:
    """CSV files with a header, or one. Keep them beside the shards, not among them."""
    rows = index.coalesce(1) if single_file else index
    rows.write.mode(mode).option("header", True).csv(path)
