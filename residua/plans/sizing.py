"""Helpers for inputs in few splits."""

from pyspark.sql import DataFrame


# Tasks a split of the scan is dealt to, so that each holds a share of bounded size.
TASKS_PER_SPLIT = 4


def spread_if_narrow(df: DataFrame) -> DataFrame:
    """A scan over all cores if it reads fewer files than there are, else as it is.

    For costly work on few input splits. Large files are dealt to more tasks than cores, in
    proportion to their splits. Lists the files; no job runs.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    return df.repartition(max(cores, TASKS_PER_SPLIT * df.rdd.getNumPartitions()))
