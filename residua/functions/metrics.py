"""Metric arithmetic, the metric log line and its parser, as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ten metrics scraped from a training log, in their usual order.
METRIC_PATTERNS = {
    "epoch": r"Epoch: ([0-9.]*)",
    "step": r"Step: ([0-9.]*)",
    "train_loss": r"Training Loss: ([0-9.e-]*)",
    "train_perplexity": r"Training Perplexity: ([0-9.e-]*)",
    "train_samples_per_second": r"Training Samples/sec: ([0-9.e-]*)",
    "train_tokens_per_second": r"Training Tokens/sec: ([0-9.e-]*)",
    "eval_loss": r"Eval Loss: ([0-9.e-]*)",
    "eval_perplexity": r"Eval Perplexity: ([0-9.e-]*)",
    "eval_samples_per_second": r"Eval Samples/sec: ([0-9.e-]*)",
    "eval_tokens_per_second": r"Eval Tokens/sec: ([0-9.e-]*)",
}

# The elapsed-time lines of a run.
ELAPSED_PATTERNS = {
    "elapsed_epoch": r"(?:Train|Eval|Total) Epoch ([0-9]+) completed in",
    "train_seconds": r"Train Epoch [0-9]+ completed in ([0-9.e-]+)",
    "eval_seconds": r"Eval Epoch [0-9]+ completed in ([0-9.e-]+)",
    "epoch_seconds": r"Total Epoch [0-9]+ completed in ([0-9.e-]+)",
    "device_seconds": r"CUDA event elapsed time[^:]*: ([0-9.e-]+)sec",
    "run_seconds": r"Run completed in ([0-9.e-]+) sec",
}

# The captures above stop at an overflow ("inf") or a positive exponent; this one
# reads both.
NARROW_CAPTURE = "([0-9.e-]*)"
WIDE_CAPTURE = "(-?[0-9.]+(?:e[+-]?[0-9]+)?|-?inf|nan)"

WIDE_METRIC_PATTERNS = {
    name: pattern.replace(NARROW_CAPTURE, WIDE_CAPTURE)
    for name, pattern in METRIC_PATTERNS.items()
}


def perplexity(loss: Column) -> Column:
    """``exp(loss)``; Infinity once that overflows."""
    return F.exp(loss)


def in_single(value: Column) -> Column:
    """The nearest value in single precision; Infinity beyond its range."""
    return value.cast("float").cast("double")


def rate(amount: Column, seconds: Column) -> Column:
    """Per second; NULL where no time has passed."""
    return F.try_divide(amount.cast("double"), seconds.cast("double"))


def _fixed(value: Column) -> Column:
    number = value.cast("double")
    return (
        F.when(F.isnan(number), F.lit("nan"))
        .when(number == float("inf"), F.lit("inf"))
        .when(number == float("-inf"), F.lit("-inf"))
        .otherwise(F.format_string("%.4f", number))
    )


def _decimal(value: Column) -> Column:
    """A float as text without an exponent."""
    number = F.abs(value.cast("double"))
    plain = (number == 0) | ((number >= 1e-3) & (number < 1e7))
    return F.when(plain, value.cast("string")).otherwise(F.format_string("%.9f", value.cast("double")))


def metric_line(
    prefix: str,
    epoch: Column,
    step: Column,
    loss: Column,
    samples_per_second: Column,
    tokens_per_second: Column,
    seconds: Column,
    single: bool = False,
) -> Column:
    """One report as text. Training steps print as a float, evaluation steps do not.

    ``single`` takes loss and perplexity through single precision, as scripts do that hold
    them in tensors; rates and times are doubles there too.
    """
    if prefix not in ("Training", "Eval"):
        raise ValueError(f"prefix must be 'Training' or 'Eval', got {prefix!r}")
    shown = F.format_string("%.1f", step.cast("double")) if prefix == "Training" else step.cast("bigint").cast("string")
    loss = in_single(loss) if single else loss
    spread = in_single(perplexity(loss)) if single else perplexity(loss)
    # The words of a line.
    return F.concat(
        F.lit("Epoch: "), epoch.cast("string"),
        F.lit(", Step: "), shown,
        F.lit(f", {prefix} Loss: "), _fixed(loss),
        F.lit(f", {prefix} Perplexity: "), _fixed(spread),
        F.lit(f", {prefix} Samples/sec: "), _fixed(samples_per_second),
        F.lit(f", {prefix} Tokens/sec: "), _fixed(tokens_per_second),
        F.lit(f", {prefix} Total time taken for the step :"), _decimal(seconds),
    )


def metric_value(line: Column, pattern: str) -> Column:
    """The first capture as a number; NULL when the line has none."""
    text = F.regexp_extract(line, pattern, 1)
    return F.nullif(text, F.lit("")).try_cast("double")
