"""FASTA text as one row per record."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _first_of_files(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Whether a row is the first of its file: the first of a block that begins at 0.

    The rows of a block come in order. Only two numbers a row are looked at.
    """
    last = None
    for files, starts in batches:
        flags = []
        for file, start in zip(files.to_pylist(), starts.to_pylist()):
            flags.append(start == 0 and file != last)
            last = file if start == 0 else None
        yield pa.array(flags, pa.bool_())


def record_text(spark: SparkSession, path, lead_in: str = "raise") -> DataFrame:
    """Raw records without their leading ``>``: the scan itself splits at a line break and ``>``.

    A record that crosses a file split is read whole by the task in whose split it starts, so
    plain files parallelise. Gzip files are one task each. Blank lines before a file's first
    header are dropped. Other text there is an error, or dropped with ``lead_in="drop"``. So is
    a carriage return without a line feed, which some programs take as a line break. A bare
    ``>`` that is the very last byte of a file is not seen.
    """
    if lead_in not in ("raise", "drop"):
        raise ValueError(f"lead_in must be 'raise' or 'drop', got {lead_in!r}")
    # Depends on the rows before: not to be evaluated again behind the filter.
    first = F.arrow_udf(_first_of_files, "boolean").asNondeterministic()
    meta = [F.xxhash64("_metadata.file_path"), F.col("_metadata.file_block_start")]
    rows = spark.read.option("lineSep", "\n>").text(path).select("value", first(*meta).alias("first"))
    opens = F.col("value").startswith(">")
    blank = F.btrim("value", F.lit("\r\n")) == ""
    rows = rows.where(~F.col("first") | (opens if lead_in == "drop" else ~blank))
    value = F.when(F.col("first"), F.substr("value", F.lit(2))).otherwise(F.col("value"))
    before = F.concat(F.lit("text before the first header: "), F.substring("value", 1, 80))
    lone = F.lit("a carriage return without a line feed in the record that begins: ")
    checked = (
        F.when(F.col("first") & ~opens, F.raise_error(before))
        .when(F.col("value").contains("\r") & F.col("value").rlike(r"\r[^\n]"),
              F.raise_error(F.concat(lone, F.substring("value", 1, 80))))
        .otherwise(value)
    )
    return rows.select(checked.alias("value"))


def record_id(value: Column) -> Column:
    """The whole header line."""
    header = F.substring_index(value, "\n", 1)
    return F.regexp_replace(header, r"\r$", "")


def record_sequence(value: Column) -> Column:
    """The body lines joined; empty for a header without a body."""
    end_of_header = F.instr(value, "\n")
    body = F.when(end_of_header > 0, F.substr(value, end_of_header + 1)).otherwise(F.lit(""))
    nothing = F.lit("")
    return F.replace(F.replace(body, F.lit("\n"), nothing), F.lit("\r"), nothing)


def read_fasta(
    spark: SparkSession, path, partitions: int | None = None, lead_in: str = "raise"
) -> DataFrame:
    """``sequence, sequence_id`` of every record in plain or gzip FASTA files.

    ``partitions`` spreads the records over that many tasks; use it for gzip input,
    which arrives in one task per file.
    """
    records = record_text(spark, path, lead_in)
    if partitions:
        records = records.repartition(partitions)
    return records.select(
        record_sequence(F.col("value")).alias("sequence"),
        record_id(F.col("value")).alias("sequence_id"),
    )


def files_without_header(spark: SparkSession, path) -> DataFrame:
    """Files whose text does not begin with ``>``, but for blank lines."""
    start = F.col("_metadata.file_block_start") == 0
    text = spark.read.option("lineSep", "\n>").text(path)
    return (
        text.where(start & (F.btrim("value", F.lit("\r\n")) != ""))
        .groupBy(F.col("_metadata.file_path").alias("file_path"))
        .agg(F.max(F.col("value").startswith(">")).alias("opens"))
        .where(~F.col("opens"))
        .select("file_path")
    )
