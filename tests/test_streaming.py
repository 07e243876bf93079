from residua.operators import reports
from residua.schemas import LOG_LINES
from residua.sources import read_log
from residua.streaming import follow_rolled_metrics


def lines(spark, start, n):
    rows = [(f"Epoch: 0, Step: {i}.0, Training Loss: {i}.5000, noise",) for i in range(start, start + n)]
    return spark.createDataFrame([*rows, ("noise",)], LOG_LINES).repartition(3)


def follow(spark, root):
    follow_rolled_metrics(
        spark, str(root / "log"), str(root / "table"), str(root / "state"), files_per_trigger=1
    ).awaitTermination()
    return spark.read.parquet(str(root / "table"))


def test_stream_equals_batch_and_never_repeats(spark, tmp_path):
    log = str(tmp_path / "log")
    for start, total in ((0, 20), (20, 35)):
        reports.write_log(lines(spark, start, total - start), log, mode="append")
        streamed = follow(spark, tmp_path)
        batch = reports.parse_metrics(read_log(spark, log))
        assert streamed.columns == batch.columns
        assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))
        assert streamed.where("step is not null").count() == total
    again = follow(spark, tmp_path)
    assert again.where("step is not null").count() == 35
