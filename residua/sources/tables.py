"""Scans of the tables between the stages. No schema is inferred."""

from urllib.parse import quote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import INDEX_MAP, KEYED_ITEMS, LOG_LINES, SEQUENCES


def read_sequences_csv(spark: SparkSession, path, null_as_empty: bool = True) -> DataFrame:
    """``sequence, sequence_id`` from CSV with a header; blanks around a value belong to it.

    CSV cannot tell an empty value from a missing one; ``null_as_empty`` reads both as empty.
    """
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows = spark.read.schema(SEQUENCES).options(**options).csv(path)
    return rows.na.fill("", ["sequence", "sequence_id"]) if null_as_empty else rows


def _below(root: str, path: Column) -> Column:
    """A file's path below the root; the whole path where the root is a pattern."""
    # File metadata spell letters beyond ASCII as they are.
    folder = "".join(c if ord(c) > 127 else quote(c, safe="/=:@!$&'()*+,;~") for c in urlparse(root).path).rstrip("/")
    return F.substring_index(path, f"{folder}/", -1)


def read_shards(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """Parquet rows with ``file_name`` and ``row_index``, their place on disk.

    A file is named by its path below ``path``, which is unique: one task of a partitioned
    write uses the same base name in every directory.
    """
    shards = spark.read.parquet(path)
    return shards.select(
        *(columns if columns is not None else shards.columns),
        _below(path, F.col("_metadata.file_path")).alias("file_name"),
        F.col("_metadata.row_index").alias("row_index"),
    )


def list_shards(spark: SparkSession, path: str) -> DataFrame:
    """``file_name, path`` of the Parquet files below ``path``; none of them is opened."""
    options = {"pathGlobFilter": "*.parquet", "recursiveFileLookup": True}
    files = spark.read.format("binaryFile").options(**options).load(path)
    return files.select(_below(path, F.col("_metadata.file_path")).alias("file_name"), "path")


def read_files(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """``file_name, row_index`` of the rows of some shards below ``root``; no column is read."""
    rows = spark.read.option("basePath", root).parquet(*paths)
    return rows.select(
        _below(root, F.col("_metadata.file_path")).alias("file_name"), F.col("_metadata.row_index").alias("row_index")
    )


def read_shard(spark: SparkSession, path: str, file_name: str) -> DataFrame:
    """The rows of one shard; the filter prunes the file list, nothing else is opened."""
    return spark.read.parquet(path).where(_below(path, F.col("_metadata.file_path")) == file_name)


def read_index_map(spark: SparkSession, path) -> DataFrame:
    """All CSV files of a folder, markers such as ``_SUCCESS`` left out, or one file."""
    return spark.read.schema(INDEX_MAP).options(header=True, pathGlobFilter="*.csv").csv(path)


def _csv_files(spark: SparkSession, folder: str, most: int) -> list[str]:
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    )
    return [row.path for row in listing.select("path").sort("path").limit(most).collect()]


def index_file_path(spark: SparkSession, base: str, folder: str) -> str:
    """The CSV file of a map that was written as one file."""
    files = _csv_files(spark, f"{base.rstrip('/')}/{folder}", 2)
    if not files:
        raise FileNotFoundError(f"no .csv file in {folder!r} below {base!r}")
    if len(files) > 1:
        raise ValueError(f"{folder!r} below {base!r} has several .csv files; read the folder")
    return files[0]


def read_index_map_folder(spark: SparkSession, base: str, folder: str) -> DataFrame:
    """The map in all part files of a folder."""
    path = f"{base.rstrip('/')}/{folder}"
    if not _csv_files(spark, path, 1):
        raise FileNotFoundError(f"no .csv file in {folder!r} below {base!r}")
    return read_index_map(spark, path)


def read_items(spark: SparkSession, path) -> DataFrame:
    """Keyed items as stored: decimal lists under an integer key."""
    return spark.read.schema(KEYED_ITEMS).parquet(path)


def read_log(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema(LOG_LINES).text(path)
