"""Metrics from rolled log files that keep arriving.

A file is read once, when it is first seen: lines that are added to it later are not. Logs
must therefore be rolled, and only finished files may match ``files``.

Parsing is stateless, so the batch expressions run unchanged on a stream; there is no
watermark to set and no state to lose.
"""

from pyspark.sql import DataFrame, SparkSession

from ..functions.metrics import METRIC_PATTERNS
from ..operators.reports import parse_metrics
from ..schemas import LOG_LINES


def rolled_metrics_stream(
    spark: SparkSession,
    path: str,
    definitions=METRIC_PATTERNS,
    files_per_trigger: int = 1000,
    files: str = "*",
) -> DataFrame:
    """Streaming table of parsed lines of the finished text files that appear in ``path``."""
    lines = (
        spark.readStream.schema(LOG_LINES)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("pathGlobFilter", files)
        .text(path)
    )
    return parse_metrics(lines, definitions)


def follow_rolled_metrics(
    spark: SparkSession,
    log_path: str,
    table_path: str,
    checkpoint: str,
    once: bool = True,
    definitions=METRIC_PATTERNS,
    files_per_trigger: int = 1000,
    files: str = "*",
):
    """Appends parsed lines of finished files to a Parquet table, exactly once per line.

    ``once`` takes what is there and stops; otherwise the query keeps following.
    Returns the streaming query.
    """
    writer = (
        rolled_metrics_stream(spark, log_path, definitions, files_per_trigger, files)
        .writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")
    return writer.start()
