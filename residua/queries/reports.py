"""Run plans, training and evaluation reports, log lines and their parsers."""

from pyspark.sql import functions as F

from ..functions import metrics
from ..operators import reports, runplan
from ..plans.workspace import new_path
from ..sources import read_log
from ..streaming import follow_growing_metrics, follow_rolled_metrics
from .registry import Registry
from .standins import ACCUMULATION, BATCH_LOSSES_SQL, MAX_LENGTH, RANKS, Tables

LOGGING_STEPS = 4
DIGITS = 6


def rounded(df, *names):
    """Doubles to six digits: sums may run in any order."""
    return df.select(*[F.round(c, DIGITS).alias(c) if c in names else c for c in df.columns])


RATES = ("loss", "perplexity", "samples_per_second", "tokens_per_second")


def runs(t: Tables):
    """A run configuration per part; the data set is the documents."""
    part = F.col("p_partkey")
    rows = t("documents").agg(F.count("*")).scalar()
    return t("part").select(
        "p_partkey",
        (1 + part % 3).cast("int").alias("num_epochs"),
        F.col("p_size").alias("per_device_train_batch_size"),
        F.col("p_size").alias("per_device_eval_batch_size"),
        (1 + part % 10).cast("int").alias("gradient_accumulation_steps"),
        (1 + part % 5).cast("int").alias("logging_steps"),
        F.lit(512).alias("max_length"),
        (8 * (1 + part % 4)).cast("int").alias("world_size"),
    ).withColumn("num_rows", rows)


def training_plan(t: Tables):
    planned = runplan.with_num_batches(runs(t), F.col("num_rows"))
    return runplan.run_plan(planned, keep=["p_partkey"])


def evaluation_plan(t: Tables):
    planned = runplan.with_num_batches(runs(t), F.col("num_rows"), "per_device_eval_batch_size")
    return runplan.eval_plan(planned, keep=["p_partkey"])


def perplexities(t: Tables):
    """Overflows for the dear order lines; compared by logarithm, which is finite."""
    value = metrics.perplexity(F.col("l_extendedprice") / 100)
    finite = value < float("inf")
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", F.round("l_extendedprice", 2).alias("price"),
        (~finite).alias("overflow"),
        F.round(F.when(finite, F.ln(value)), DIGITS).alias("log_perplexity"),
    )


def rates(t: Tables):
    seconds = (1 + F.col("user_id") % 10) / 4
    return t("events").select(
        "event_id",
        F.round(metrics.rate(F.col("value"), seconds), DIGITS).alias("per_second"),
    )


def windows(t: Tables, compat: bool):
    return rounded(reports.window_losses(t.batch_losses, ACCUMULATION, compat), "loss", "seconds")


def window_samples(t: Tables):
    """Samples of a step over all ranks, exact and as the reporting rank's times ranks."""
    per_rank = reports.window_losses(t.batch_losses, ACCUMULATION)
    exact = reports.mean_over_ranks(per_rank, ["epoch", "step"])
    compat = reports.mean_over_ranks(per_rank, ["epoch", "step"], compat=True)
    return exact.select("epoch", "step", "samples").join(
        compat.select("epoch", "step", F.col("samples").alias("scaled_samples")), ["epoch", "step"]
    )


def rank_means(t: Tables):
    per_rank = reports.window_losses(t.batch_losses, ACCUMULATION)
    means = reports.mean_over_ranks(per_rank, ["epoch", "step"])
    return rounded(means.select("epoch", "step", "loss", "ranks"), "loss")


def training(t: Tables, **options):
    report = reports.training_report(t.batch_losses, ACCUMULATION, MAX_LENGTH, **options)
    return rounded(report, *RATES)


def evaluation(t: Tables, compat: bool):
    return rounded(reports.eval_report(t.batch_losses, MAX_LENGTH, compat), *RATES)


def evaluation_losses(t: Tables):
    losses = reports.eval_losses(t.batch_losses)
    return rounded(losses.select("epoch", "rank", "loss"), "loss")


def evaluation_samples(t: Tables):
    return reports.eval_losses(t.batch_losses).select("epoch", "rank", "samples", "batches")


def evaluation_steps(t: Tables):
    return reports.eval_report(t.batch_losses, MAX_LENGTH).select("epoch", "step")


def window_counter(t: Tables):
    per_rank = reports.window_losses(t.batch_losses, ACCUMULATION)
    return per_rank.groupBy("epoch", "rank").agg(
        F.min("step").alias("first_step"), F.max("step").alias("last_step"),
        F.count("*").alias("steps"),
    )


def window_boundaries(t: Tables):
    """Batches after which a step is taken: the last of their window."""
    step = F.floor(F.col("batch_idx") / ACCUMULATION)
    return t.batch_losses.groupBy("epoch", "rank", step.alias("window")).agg(
        F.max("batch_idx").alias("batch_idx")
    ).select("epoch", "rank", "batch_idx")


def one_line_per_step(t: Tables):
    """Each (epoch, step) prints once, whatever the number of ranks."""
    lines = reports.parse_metrics(t.training_lines)
    return lines.groupBy("epoch", "step").agg(F.count("*").alias("lines"))


def lines_of_reports(t: Tables):
    return t.training_lines.unionAll(t.eval_lines)


def lines_in_single(t: Tables):
    """Lines of runs that hold their losses in single precision; some overflow there."""
    steps = reports.training_report(t.batch_losses, ACCUMULATION, MAX_LENGTH, compat=True)
    epochs = reports.eval_report(t.batch_losses, MAX_LENGTH, compat=True)
    return reports.format_metrics(steps, "Training", single=True).unionAll(
        reports.format_metrics(epochs, "Eval", single=True)
    )


def log_scan(t: Tables):
    return read_log(t.spark, t.log)


def parsed_log(t: Tables):
    return reports.parse_metrics(read_log(t.spark, t.log))


def parsed_log_rows(t: Tables):
    return reports.metric_rows(parsed_log(t))


def large_steps(t: Tables):
    """Lines of runs that diverged, at steps of eight digits: written, then read again."""
    event = F.col("event_id")
    loss = (
        F.when(event % 7 == 0, F.lit(float("nan"))).when(event % 7 == 1, F.lit(float("inf")))
        .when(event % 7 == 2, F.lit(float("-inf"))).otherwise(F.round(F.col("value") * 100) / 997)
    )
    report = t("events").select(
        F.lit(1).alias("epoch"), (event * 1000 + 10_000_000).alias("step"), loss.alias("loss"),
        F.lit(1.5).alias("samples_per_second"), F.lit(2.5).alias("tokens_per_second"), F.lit(0.0001).alias("seconds"),
    )
    parsed = reports.parse_metrics(reports.format_metrics(report, "Training"), metrics.WIDE_METRIC_PATTERNS)
    found = F.col("train_loss")
    finite = F.abs(found) < float("inf")
    return parsed.select(
        "epoch", "step", F.isnan(found).alias("is_nan"), (found == float("inf")).alias("is_inf"),
        (found == float("-inf")).alias("is_minus_inf"), F.when(finite, F.round(found, 4)).alias("loss"),
    )


def followed_log(t: Tables):
    table, checkpoint = new_path(t.spark, "followed"), new_path(t.spark, "followed-state")
    follow_rolled_metrics(t.spark, t.log, table, checkpoint, files_per_trigger=2).awaitTermination()
    return t.spark.read.parquet(table)


def appended_log(t: Tables):
    """A log that grows between two runs of the stream, which goes on where it stopped."""
    log, table, checkpoint = (new_path(t.spark, n) for n in ("growing", "growing-table", "growing-state"))
    for lines in (t.training_lines, t.eval_lines):
        reports.write_log(lines, log, mode="append")
        follow_growing_metrics(t.spark, log, table, checkpoint, files="*.txt").awaitTermination()
    return t.spark.read.parquet(table)


def written_log(t: Tables):
    path = new_path(t.spark, "snk5")
    reports.write_log(t.training_lines, path)
    return read_log(t.spark, path)


ELAPSED = {
    "Train": "--> Train Epoch %s completed in %s",
    "Eval": "--> Eval Epoch %s completed in %s",
    "Total": "--> Total Epoch %s completed in %s",
}


def elapsed_lines(t: Tables):
    """A user plays an epoch: its seconds in training, evaluation and both."""
    seconds = t("events").groupBy("user_id").agg(
        F.sum((1 + F.col("event_id") % 8) / 8).alias("Train"),
        F.sum((1 + F.col("event_id") % 4) / 4).alias("Eval"),
    ).withColumn("Total", F.col("Train") + F.col("Eval"))
    user = F.col("user_id").cast("string")
    lines = F.array(*[
        F.format_string(line, user, F.col(kind).cast("string")) for kind, line in ELAPSED.items()
    ], F.format_string("--> CUDA event elapsed time with checkpoint saving : %ssec",
                       F.col("Total").cast("string")),
       F.format_string("--> Run completed in %s sec.", F.col("Total").cast("string")))
    return seconds.select(F.explode(lines).alias("value"))


def parsed_elapsed(t: Tables):
    return reports.parse_metrics(elapsed_lines(t), metrics.ELAPSED_PATTERNS)


RUNS_SQL = """
    SELECT p_partkey, 1 + p_partkey % 3 AS num_epochs, p_size::BIGINT AS bs,
           1 + p_partkey % 10 AS gas, 1 + p_partkey % 5 AS logging_steps, 512 AS max_length,
           8 * (1 + p_partkey % 4) AS w, (SELECT count(*) FROM documents) AS n
    FROM part"""

PLANNED_SQL = f"""
    SELECT *, ceil(ceil(n / w) / bs)::BIGINT AS batches FROM ({RUNS_SQL})"""


def windows_sql(divisor: str) -> str:
    return f"""
        SELECT epoch, batch_idx // {ACCUMULATION} + 1 AS step, rank, sum(loss) / {divisor} AS loss,
               sum(batch_size)::BIGINT AS samples, count(*) AS batches, sum(seconds) AS seconds
        FROM ({BATCH_LOSSES_SQL}) GROUP BY 1, 2, 3"""


def report_sql(compat: bool, keep: str = "true") -> str:
    windows = windows_sql(str(ACCUMULATION) if compat else "count(*)")
    samples = "max(samples) FILTER (rank = 0) * count(*)" if compat else "sum(samples)"
    seconds = "max(seconds) FILTER (rank = 0)" if compat else "max(seconds)"
    return f"""
        SELECT *, samples * {MAX_LENGTH} AS tokens
        FROM (SELECT epoch, step, avg(loss) AS loss, ({samples})::BIGINT AS samples,
                     {seconds} AS seconds
              FROM ({windows}) GROUP BY 1, 2)
        WHERE {keep}"""


def eval_sql(compat: bool) -> str:
    samples = "max(samples) FILTER (rank = 0)" if compat else "sum(samples)"
    factor = "count(*)" if compat else "1"
    seconds = "max(seconds) FILTER (rank = 0)" if compat else "max(seconds)"
    return f"""
        SELECT epoch, (epoch + 1) * max(batches) AS step, avg(loss) AS loss,
               ({samples} * {factor})::BIGINT AS samples,
               ({samples} * {MAX_LENGTH})::BIGINT AS tokens, {seconds} AS seconds
        FROM (SELECT epoch, rank, avg(loss) AS loss, sum(batch_size) AS samples,
                     count(*) AS batches, sum(seconds) AS seconds
              FROM ({BATCH_LOSSES_SQL}) GROUP BY 1, 2) GROUP BY epoch"""


def columns_sql(source: str) -> str:
    return f"""
        SELECT epoch::INTEGER AS epoch, step::BIGINT AS step, round(loss, 6) AS loss,
               round(exp(loss), 6) AS perplexity, samples, tokens, seconds,
               round(samples / seconds, 6) AS samples_per_second,
               round(tokens / seconds, 6) AS tokens_per_second
        FROM ({source})"""


def line_sql(prefix: str, source: str, step: str, loss: str = "loss", spread: str = "exp(loss)") -> str:
    def fixed(value: str) -> str:
        return f"printf('%.4f', round({value}, 4))"

    return f"""
        SELECT concat('Epoch: ', epoch, ', Step: ', {step},
                      ', {prefix} Loss: ', {fixed(loss)},
                      ', {prefix} Perplexity: ', {fixed(spread)},
                      ', {prefix} Samples/sec: ', {fixed("samples / seconds")},
                      ', {prefix} Tokens/sec: ', {fixed("tokens / seconds")},
                      ', {prefix} Total time taken for the step :', seconds::DOUBLE) AS value
        FROM ({source})"""


TRAINING_LINES_SQL = line_sql("Training", report_sql(False), "step::DOUBLE")
LINES_SQL = f"""
    {TRAINING_LINES_SQL} UNION ALL {line_sql("Eval", eval_sql(False), "step::BIGINT")}"""


def parse_sql(patterns: dict, lines: str, counters: tuple) -> str:
    def column(name: str, pattern: str) -> str:
        number = f"TRY_CAST(nullif(regexp_extract(value, '{pattern}', 1), '') AS DOUBLE)"
        return f"{number}{'::BIGINT' if name in counters else ''} AS {name}"

    return f"SELECT {', '.join(column(*p) for p in patterns.items())} FROM ({lines})"


ELAPSED_SQL = """
    SELECT unnest([
        concat('--> Train Epoch ', user_id, ' completed in ', train),
        concat('--> Eval Epoch ', user_id, ' completed in ', eval),
        concat('--> Total Epoch ', user_id, ' completed in ', train + eval),
        concat('--> CUDA event elapsed time with checkpoint saving : ', train + eval, 'sec'),
        concat('--> Run completed in ', train + eval, ' sec.')]) AS value
    FROM (SELECT user_id, sum((1 + event_id % 8) / 8) AS train,
                 sum((1 + event_id % 4) / 4) AS eval
          FROM events GROUP BY user_id)"""


def register(r: Registry) -> None:
    parsed = parse_sql(metrics.METRIC_PATTERNS, LINES_SQL, ("epoch", "step"))
    measured = [n for n in metrics.METRIC_PATTERNS if n not in ("epoch", "step")]
    r.add("met1_training_plan", training_plan, f"""
        SELECT p_partkey, batches AS total_no_of_batches_per_gpu,
               bs::INTEGER AS per_device_train_batch_size, num_epochs::INTEGER AS epochs,
               ceil(batches / gas)::BIGINT AS num_update_steps_per_epoch,
               num_epochs * ceil(batches / gas)::BIGINT AS num_total_training_steps,
               bs * w AS total_train_batch_size,
               bs * w * gas AS total_train_batch_size_with_gradient_accumulation,
               bs * w * gas * logging_steps AS samples_processed_per_logging_update,
               bs * w * gas * logging_steps * max_length AS tokens_processed_per_logging_update,
               bs * w * gas * max_length AS total_tokens_per_batch
        FROM ({PLANNED_SQL})""")
    r.add("met2_evaluation_plan", evaluation_plan, f"""
        SELECT p_partkey, batches AS num_eval_steps_per_epoch, bs * w AS total_eval_batch_size,
               bs * w * batches AS samples_processed_per_logging_update,
               bs * w * batches * max_length AS tokens_processed_per_logging_update
        FROM ({PLANNED_SQL})""")
    r.add("met3_perplexity", perplexities, """
        SELECT l_orderkey, l_linenumber, round(l_extendedprice, 2) AS price,
               l_extendedprice / 100 > 709.782712893384 AS overflow,
               CASE WHEN l_extendedprice / 100 <= 709.782712893384
                    THEN round(l_extendedprice / 100, 6) END AS log_perplexity
        FROM lineitem""")
    r.add("met4_rates", rates, """
        SELECT event_id, round(value / ((1 + user_id % 10) / 4), 6) AS per_second FROM events""")
    r.add("met5_training_report", training, columns_sql(report_sql(False)))
    r.add("met5_training_report_compat", lambda t: training(t, compat=True),
          columns_sql(report_sql(True)))
    r.add("fil7_every_kth_step", lambda t: training(t, logging_steps=LOGGING_STEPS),
          columns_sql(report_sql(False, f"step % {LOGGING_STEPS} = 0")))
    r.add("met6_evaluation_report", lambda t: evaluation(t, False), columns_sql(eval_sql(False)))
    r.add("met6_evaluation_report_compat", lambda t: evaluation(t, True),
          columns_sql(eval_sql(True)))
    r.add("met7_cumulative_step", evaluation_steps, f"""
        SELECT epoch::INTEGER AS epoch, step FROM ({eval_sql(False)})""")
    r.add("met8_elapsed_times", parsed_elapsed,
          parse_sql(metrics.ELAPSED_PATTERNS, ELAPSED_SQL, ("elapsed_epoch",)))

    windows_columns = """
        SELECT epoch::INTEGER AS epoch, step::BIGINT AS step, rank::INTEGER AS rank,
               round(loss, 6) AS loss, samples, batches, round(seconds, 6) AS seconds"""
    r.add("agg4_window_loss", lambda t: windows(t, False),
          f"{windows_columns} FROM ({windows_sql('count(*)')})")
    r.add("agg4_window_loss_compat", lambda t: windows(t, True),
          f"{windows_columns} FROM ({windows_sql(str(ACCUMULATION))})")
    r.add("agg3_mean_over_ranks", rank_means, f"""
        SELECT epoch::INTEGER AS epoch, step::BIGINT AS step, round(avg(loss), 6) AS loss,
               {RANKS}::BIGINT AS ranks
        FROM ({windows_sql("count(*)")}) GROUP BY 1, 2""")
    r.add("agg5_window_samples", window_samples, f"""
        SELECT epoch::INTEGER AS epoch, step::BIGINT AS step, sum(samples)::BIGINT AS samples,
               (max(samples) FILTER (rank = 0) * count(*))::BIGINT AS scaled_samples
        FROM ({windows_sql("count(*)")}) GROUP BY 1, 2""")
    r.add("agg6_evaluation_loss", evaluation_losses, f"""
        SELECT epoch::INTEGER AS epoch, rank::INTEGER AS rank, round(avg(loss), 6) AS loss
        FROM ({BATCH_LOSSES_SQL}) GROUP BY 1, 2""")
    r.add("agg7_evaluation_samples", evaluation_samples, f"""
        SELECT epoch::INTEGER AS epoch, rank::INTEGER AS rank,
               sum(batch_size)::BIGINT AS samples, count(*) AS batches
        FROM ({BATCH_LOSSES_SQL}) GROUP BY 1, 2""")
    r.add("agg9_window_counter", window_counter, f"""
        SELECT epoch::INTEGER AS epoch, rank::INTEGER AS rank, 1::BIGINT AS first_step,
               (max(batch_idx) // {ACCUMULATION} + 1)::BIGINT AS last_step,
               count(DISTINCT batch_idx // {ACCUMULATION}) AS steps
        FROM ({BATCH_LOSSES_SQL}) GROUP BY 1, 2""")
    r.add("fil8_window_boundaries", window_boundaries, f"""
        SELECT epoch::INTEGER AS epoch, rank::INTEGER AS rank, batch_idx::INTEGER AS batch_idx
        FROM (SELECT *, max(batch_idx) OVER (PARTITION BY epoch, rank) AS last
              FROM ({BATCH_LOSSES_SQL}))
        WHERE (batch_idx + 1) % {ACCUMULATION} = 0 OR batch_idx = last""")
    r.add("fil9_one_line_per_step", one_line_per_step, f"""
        SELECT epoch::BIGINT AS epoch, step::BIGINT AS step, 1::BIGINT AS lines
        FROM ({report_sql(False)})""")
    r.add("prj12_format_lines", lines_of_reports, LINES_SQL)
    single = {"loss": "loss::FLOAT::DOUBLE", "spread": "exp(loss::FLOAT::DOUBLE)::FLOAT::DOUBLE"}
    r.add("prj12_format_lines_compat", lines_in_single, f"""
        {line_sql("Training", report_sql(True), "step::DOUBLE", **single)}
        UNION ALL {line_sql("Eval", eval_sql(True), "step::BIGINT", **single)}""")
    r.add("src10_log_scan", log_scan, LINES_SQL)
    r.add("prj11_parse_log", parsed_log, parsed)
    r.add("prj11_large_steps", large_steps, """
        SELECT 1::BIGINT AS epoch, event_id * 1000 + 10000000 AS step, event_id % 7 = 0 AS is_nan,
               event_id % 7 = 1 AS is_inf, event_id % 7 = 2 AS is_minus_inf,
               CASE WHEN event_id % 7 > 2 THEN round(round(value * 100) / 997, 4) END AS loss
        FROM events""")
    r.add("prj11_metric_rows", parsed_log_rows, f"""
        SELECT epoch, step, metric, value FROM (
            UNPIVOT ({parsed}) ON {", ".join(measured)} INTO NAME metric VALUE value)""")
    r.add("stream_parse_log", followed_log, parsed)
    r.add("stream_appended_log", appended_log, parsed)
    r.add("snk5_written_log", written_log, TRAINING_LINES_SQL)
