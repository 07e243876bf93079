"""What a training run will process, computed from its configuration."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ceil_div(a: Column, b: Column) -> Column:
    return F.ceil(a / b).cast("bigint")


def with_num_batches(
    runs: DataFrame, num_rows: Column, batch_size: str = "per_device_train_batch_size"
) -> DataFrame:
    """Adds ``num_batches`` per rank for a data set of ``num_rows``, without reading it."""
    rows_per_rank = _ceil_div(num_rows, F.col("world_size"))
    return runs.withColumn("num_batches", _ceil_div(rows_per_rank, F.col(batch_size)))


def run_plan(runs: DataFrame, keep=()) -> DataFrame:
    """Training plan of every run; needs ``num_batches`` per rank."""
    c = F.col
    updates = _ceil_div(c("num_batches"), c("gradient_accumulation_steps"))
    batch = (c("per_device_train_batch_size") * c("world_size")).cast("bigint")
    accumulated = batch * c("gradient_accumulation_steps")
    logged = accumulated * c("logging_steps")
    return runs.select(
        *keep,
        c("num_batches").alias("total_no_of_batches_per_gpu"),
        "per_device_train_batch_size",
        c("num_epochs").alias("epochs"),
        updates.alias("num_update_steps_per_epoch"),
        (c("num_epochs") * updates).alias("num_total_training_steps"),
        batch.alias("total_train_batch_size"),
        accumulated.alias("total_train_batch_size_with_gradient_accumulation"),
        logged.alias("samples_processed_per_logging_update"),
        (logged * c("max_length")).alias("tokens_processed_per_logging_update"),
        (accumulated * c("max_length")).alias("total_tokens_per_batch"),
    )


def eval_plan(runs: DataFrame, keep=()) -> DataFrame:
    """Evaluation plan of every run; needs ``num_batches`` per rank."""
    c = F.col
    batch = (c("per_device_eval_batch_size") * c("world_size")).cast("bigint")
    samples = batch * c("num_batches")
    return runs.select(
        *keep,
        c("num_batches").alias("num_eval_steps_per_epoch"),
        batch.alias("total_eval_batch_size"),
        samples.alias("samples_processed_per_logging_update"),
        (samples * c("max_length")).alias("tokens_processed_per_logging_update"),
    )
