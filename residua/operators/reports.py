"""Training and evaluation reports from a table of per-batch losses, and log lines."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics

# The rank whose own clock and sample counter the compatible reports use.
REPORTING_RANK = 0


def window_losses(batch_losses: DataFrame, accumulation: int, compat: bool = False) -> DataFrame:
    """Per (epoch, step, rank): loss, samples and seconds of one accumulation window.

    A step is ``accumulation`` batches; the last of an epoch may be shorter. ``compat``
    divides its loss by the full window all the same, which makes it too small.
    """
    step = (F.floor(F.col("batch_idx") / accumulation) + 1).cast("bigint")
    batches = F.lit(accumulation) if compat else F.count("*")
    return batch_losses.groupBy("epoch", step.alias("step"), "rank").agg(
        (F.sum("loss").cast("double") / batches).alias("loss"),
        F.sum("batch_size").alias("samples"),
        F.count("*").alias("batches"),
        F.sum("seconds").cast("double").alias("seconds"),
    )


def mean_over_ranks(per_rank: DataFrame, keys, compat: bool = False) -> DataFrame:
    """Averages the loss over ranks and totals the samples.

    ``compat`` multiplies the reporting rank's samples by the number of ranks and takes
    its duration; otherwise samples are summed and the slowest rank sets the duration.
    """
    if compat:
        own = F.col("rank") == REPORTING_RANK
        samples = F.max(F.when(own, F.col("samples"))) * F.count("*")
        seconds = F.max(F.when(own, F.col("seconds")))
    else:
        samples, seconds = F.sum("samples"), F.max("seconds")
    return per_rank.groupBy(*keys).agg(
        F.avg("loss").alias("loss"),
        samples.alias("samples"),
        seconds.alias("seconds"),
        F.count("*").alias("ranks"),
        F.max("batches").alias("batches"),
    )


def with_rates(steps: DataFrame) -> DataFrame:
    """Adds perplexity and the two throughputs."""
    return steps.withColumns(
        {
            "perplexity": metrics.perplexity(F.col("loss")),
            "samples_per_second": metrics.rate(F.col("samples"), F.col("seconds")),
            "tokens_per_second": metrics.rate(F.col("tokens"), F.col("seconds")),
        }
    )


REPORT_COLUMNS = [
    "epoch", "step", "loss", "perplexity", "samples", "tokens", "seconds",
    "samples_per_second", "tokens_per_second",
]


def training_report(
    batch_losses: DataFrame,
    accumulation: int,
    max_length: int,
    logging_steps: int = 1,
    compat: bool = False,
) -> DataFrame:
    """One row per reported optimiser step; tokens are nominal, ``max_length`` each."""
    steps = mean_over_ranks(
        window_losses(batch_losses, accumulation, compat), ["epoch", "step"], compat
    ).where(F.col("step") % logging_steps == 0)
    steps = steps.withColumn("tokens", F.col("samples") * max_length)
    return with_rates(steps).select(*REPORT_COLUMNS)


def eval_losses(batch_losses: DataFrame) -> DataFrame:
    """Per (epoch, rank): mean loss, samples, batches and seconds of one evaluation."""
    return batch_losses.groupBy("epoch", "rank").agg(
        F.avg("loss").cast("double").alias("loss"),
        F.sum("batch_size").alias("samples"),
        F.count("*").alias("batches"),
        F.sum("seconds").cast("double").alias("seconds"),
    )


def eval_report(batch_losses: DataFrame, max_length: int, compat: bool = False) -> DataFrame:
    """One row per epoch. ``step`` counts evaluation batches of a rank over all epochs.

    ``compat`` counts the tokens of the reporting rank only, as its samples are not.
    """
    epochs = mean_over_ranks(eval_losses(batch_losses), ["epoch"], compat)
    counted = F.col("samples") / F.col("ranks") if compat else F.col("samples")
    epochs = epochs.withColumns(
        {
            "step": ((F.col("epoch") + 1) * F.col("batches")).cast("bigint"),
            "tokens": (counted * max_length).cast("bigint"),
        }
    )
    return with_rates(epochs).select(*REPORT_COLUMNS)


def format_metrics(report: DataFrame, prefix: str, keep=(), single: bool = False) -> DataFrame:
    """The report as log lines in ``value``; ``single`` as in ``metric_line``."""
    names = ["epoch", "step", "loss", "samples_per_second", "tokens_per_second", "seconds"]
    line = metrics.metric_line(prefix, *[F.col(n) for n in names], single=single)
    return report.select(*keep, line.alias("value"))


def parse_metrics(lines: DataFrame, definitions=metrics.METRIC_PATTERNS, keep=()) -> DataFrame:
    """One column per metric; lines without any metric give NULLs. Batch or stream."""
    values = [
        metrics.metric_value(F.col("value"), pattern).alias(name)
        for name, pattern in definitions.items()
    ]
    parsed = lines.select(*keep, *values)
    counters = [c for c in ("epoch", "step", "elapsed_epoch") if c in definitions]
    return parsed.withColumns({c: F.col(c).cast("bigint") for c in counters})


def metric_rows(parsed: DataFrame, ids=("epoch", "step")) -> DataFrame:
    """Long form: one row per metric that a line holds."""
    names = [c for c in parsed.columns if c not in ids]
    return parsed.unpivot(list(ids), names, "metric", "value").where("value is not null")


def write_log(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    lines.select("value").write.mode(mode).text(path)
