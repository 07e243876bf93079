import math

import pytest
from pyspark.sql import functions as F

from residua.functions import metrics
from residua.operators import reports, runplan
from residua.operators.sampler import batches_per_rank, epoch_assignment
from residua.schemas import BATCH_LOSSES, LOG_LINES


def losses(spark, batches, ranks=2, loss=2.0, epoch=0, size=4):
    rows = [(epoch, r, b, size, loss + r, 0.5 + r) for r in range(ranks) for b in range(batches)]
    return spark.createDataFrame(rows, BATCH_LOSSES)


def by_step(df):
    return df.orderBy("epoch", "step").collect()


def test_short_last_window(spark):
    table = losses(spark, 25, ranks=1)
    exact = by_step(reports.training_report(table, 10, 512))
    compat = by_step(reports.training_report(table, 10, 512, compat=True))
    assert [r.step for r in exact] == [1, 2, 3]
    assert [r.loss for r in exact] == [2.0, 2.0, 2.0]
    assert [r.loss for r in compat] == [2.0, 2.0, 1.0]
    assert [r.samples for r in exact] == [40, 40, 20]


def test_training_report(spark):
    rows = by_step(reports.training_report(losses(spark, 20), 10, 512))
    first = rows[0]
    assert (first.epoch, first.step, first.loss, first.samples) == (0, 1, 2.5, 80)
    assert first.tokens == 80 * 512 and first.seconds == 15.0
    assert first.perplexity == pytest.approx(math.exp(2.5))
    assert first.samples_per_second == pytest.approx(80 / 15)
    compat = by_step(reports.training_report(losses(spark, 20), 10, 512, compat=True))[0]
    assert compat.seconds == 5.0 and compat.samples == 80


def test_every_kth_step(spark):
    report = reports.training_report(losses(spark, 60), 5, 512, logging_steps=4)
    assert [r.step for r in by_step(report)] == [4, 8, 12]


def test_step_filter_runs_before_the_sums(spark, plan, conf):
    conf("spark.sql.adaptive.enabled", "false")
    table = losses(spark, 60).repartition(2)
    text = plan(reports.training_report(table, 5, 512, logging_steps=4))
    assert text.index("Filter") > text.rindex("partial_sum")


def test_eval_report(spark):
    table = losses(spark, 6).unionAll(losses(spark, 6, loss=1.0, epoch=1))
    exact = by_step(reports.eval_report(table, 100))
    assert [(r.step, r.loss, r.samples, r.tokens) for r in exact] == [
        (6, 2.5, 48, 4800), (12, 1.5, 48, 4800)
    ]
    compat = by_step(reports.eval_report(table, 100, compat=True))
    assert [(r.samples, r.tokens) for r in compat] == [(48, 2400), (48, 2400)]


def test_overflowing_loss(spark):
    report = reports.training_report(losses(spark, 1, ranks=1, loss=710.0), 1, 512)
    assert report.first().perplexity == math.inf
    lines = reports.format_metrics(report, "Training")
    assert "Training Perplexity: inf," in lines.first().value
    assert reports.parse_metrics(lines).first().train_perplexity is None
    wide = reports.parse_metrics(lines, metrics.WIDE_METRIC_PATTERNS).first()
    assert wide.train_perplexity == math.inf and wide.train_loss == 710.0


def test_no_time_no_rate(spark):
    table = losses(spark, 1, ranks=1).withColumn("seconds", F.lit(0.0))
    assert reports.training_report(table, 1, 512).first().samples_per_second is None


def test_line_format(spark):
    report = reports.training_report(losses(spark, 20, ranks=1, size=2), 10, 512, 2)
    line = reports.format_metrics(report, "Training").first().value
    assert line == (
        "Epoch: 0, Step: 2.0, Training Loss: 2.0000, Training Perplexity: 7.3891, "
        "Training Samples/sec: 4.0000, Training Tokens/sec: 2048.0000, "
        "Training Total time taken for the step :5.0"
    )
    line = reports.format_metrics(reports.eval_report(losses(spark, 3, ranks=1), 10), "Eval").first()
    assert line.value.startswith("Epoch: 0, Step: 3, Eval Loss: 2.0000, Eval Perplexity: 7.3891")
    for prefix in (None, "", "Test"):
        with pytest.raises(ValueError):
            reports.format_metrics(report, prefix)


def test_lines_parse_back(spark):
    table = losses(spark, 40, ranks=3, loss=1.2345)
    report = reports.training_report(table, 10, 142)
    parsed = reports.parse_metrics(reports.format_metrics(report, "Training"))
    got = {(r.epoch, r.step): r for r in parsed.collect()}
    for r in report.collect():
        line = got[(r.epoch, r.step)]
        assert line.train_loss == pytest.approx(r.loss, abs=5.1e-5)
        assert line.train_perplexity == pytest.approx(r.perplexity, abs=5.1e-5)
        assert line.train_samples_per_second == pytest.approx(r.samples_per_second, abs=5.1e-5)
        assert line.train_tokens_per_second == pytest.approx(r.tokens_per_second, abs=5.1e-5)
        assert line.eval_loss is None


def test_other_lines_give_nulls(spark):
    lines = spark.createDataFrame(
        [("Worldsize is : 8",), ("",), ("Epoch: , Step: x",), ("Training Loss: 1e-05,",)], LOG_LINES
    )
    rows = reports.parse_metrics(lines).collect()
    assert all(v is None for r in rows[:3] for v in r) and rows[3].train_loss == 1e-05
    assert reports.metric_rows(reports.parse_metrics(lines)).count() == 1


def test_elapsed_lines(spark):
    lines = spark.createDataFrame([
        ("--> Train Epoch 3 completed in 12.5",), ("--> Eval Epoch 3 completed in 2.25",),
        ("--> Total Epoch 3 completed in 15.0",),
        ("--> CUDA event elapsed time with checkpoint saving : 99.5sec",),
        ("CUDA event elapsed time: 98.5sec",), ("--> Run completed in 100.5 sec.",),
    ], LOG_LINES)
    rows = reports.parse_metrics(lines, metrics.ELAPSED_PATTERNS).collect()
    assert [r.train_seconds for r in rows] == [12.5] + [None] * 5
    assert rows[1].eval_seconds == 2.25 and rows[2].epoch_seconds == 15.0
    assert [r.elapsed_epoch for r in rows[:3]] == [3, 3, 3]
    assert (rows[3].device_seconds, rows[4].device_seconds, rows[5].run_seconds) == (99.5, 98.5, 100.5)


PLANS = [
    (2, 355, 36, 72, 16, 160, 320, 163_840, 81_920),
    (8, 89, 9, 18, 64, 640, 1_280, 655_360, 327_680),
    (14, 51, 6, 12, 112, 1_120, 2_240, 1_146_880, 573_440),
]


def run_table(spark):
    rows = [(2, b, b, 10, 2, 512, 8) for b, *_ in PLANS]
    return spark.createDataFrame(
        rows, "num_epochs int, per_device_train_batch_size int, per_device_eval_batch_size int, "
        "gradient_accumulation_steps int, logging_steps int, max_length int, world_size int")


def test_run_plans(spark):
    runs = runplan.with_num_batches(run_table(spark), F.lit(5680))
    rows = runplan.run_plan(runs).orderBy("per_device_train_batch_size").collect()
    assert [
        (r.per_device_train_batch_size, r.total_no_of_batches_per_gpu, r.num_update_steps_per_epoch,
         r.num_total_training_steps, r.total_train_batch_size,
         r.total_train_batch_size_with_gradient_accumulation, r.samples_processed_per_logging_update,
         r.tokens_processed_per_logging_update, r.total_tokens_per_batch) for r in rows
    ] == PLANS
    evaluated = runplan.eval_plan(runs).orderBy("total_eval_batch_size").collect()
    assert [tuple(r) for r in evaluated] == [
        (355, 16, 5680, 2_908_160), (89, 64, 5696, 2_916_352), (51, 112, 5712, 2_924_544)
    ]


@pytest.mark.parametrize("n, world, batch", [(100, 8, 3), (7, 4, 2), (64, 8, 8), (1, 3, 5)])
def test_planned_batches_are_the_sampler_s(spark, n, world, batch):
    assigned = epoch_assignment(spark.range(n), world, batch)
    counted = {r.num_batches for r in batches_per_rank(assigned).collect()}
    runs = run_table(spark).limit(1).withColumn("world_size", F.lit(world)).withColumn(
        "per_device_train_batch_size", F.lit(batch))
    assert counted == {runplan.with_num_batches(runs, F.lit(n)).first().num_batches}


def test_odd_numbers_in_lines(spark):
    from residua.functions.metrics import WIDE_METRIC_PATTERNS

    rows = [(0, s, x, 1.0, 1.0, t) for s, x, t in [
        (10_000_000, float("nan"), 0.0001), (12_345_678, float("inf"), 1e9), (3, float("-inf"), 2.5), (4, 1.5, 0.0)]]
    report = spark.createDataFrame(
        rows, "epoch int, step bigint, loss double, samples_per_second double, tokens_per_second double, seconds double")
    lines = reports.format_metrics(report, "Training")
    assert not any("E" in r.value.split("time")[1] or "E-" in r.value for r in lines.collect())
    assert "Step: 10000000.0," in lines.first().value
    parsed = reports.parse_metrics(lines, WIDE_METRIC_PATTERNS).orderBy("step").collect()
    assert [r.step for r in parsed] == [3, 4, 10_000_000, 12_345_678]
    assert [str(r.train_loss) for r in parsed] == ["-inf", "1.5", "nan", "inf"]
