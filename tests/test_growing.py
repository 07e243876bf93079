import pytest

from residua.streaming import follow_growing_metrics, growing_lines_stream
from residua.streaming.growing import GrowingReader


def run(spark, root, **options):
    """One run of the stream; all lines that have arrived so far."""
    lines = growing_lines_stream(spark, str(root / "log"), **options)
    writer = lines.writeStream.format("parquet").option("path", str(root / "out"))
    writer.option("checkpointLocation", str(root / "state")).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema("value string, file string, start bigint").parquet(str(root / "out")).collect()
    return sorted((r.file.rsplit("/", 1)[1], r.start, r.value) for r in rows)


def append(root, name, data):
    (root / "log").mkdir(exist_ok=True)
    with open(root / "log" / name, "ab") as file:
        file.write(data)


def test_appended_lines_arrive_once(spark, tmp_path):
    append(tmp_path, "a.log", b"one\ntwo\nthr")
    append(tmp_path, "_ignored", b"x\n")
    assert run(spark, tmp_path) == [("a.log", 0, "one"), ("a.log", 4, "two")]
    append(tmp_path, "a.log", b"ee\r\n\nfive")
    append(tmp_path, "b.log", "é\n".encode())
    want = [("a.log", 0, "one"), ("a.log", 4, "two"), ("a.log", 8, "three"), ("a.log", 15, ""), ("b.log", 0, "é")]
    assert run(spark, tmp_path) == want
    # Nothing new, then the end of the line that was kept back.
    assert run(spark, tmp_path) == want
    append(tmp_path, "a.log", b"\n")
    assert run(spark, tmp_path) == sorted([*want, ("a.log", 16, "five")])


@pytest.mark.parametrize("piece", [1, 3, 7, 1000])
def test_pieces_cut_no_line(spark, tmp_path, piece):
    data = b"".join(b"line %d %s\n" % (i, b"x" * (i % 11)) for i in range(200))
    append(tmp_path, "a.log", data)
    reader = GrowingReader({"path": str(tmp_path / "log"), "pieceBytes": str(piece)})
    end = reader.latestOffset()
    got = [
        (start, value) for p in reader.partitions({}, end) for b in reader.read(p)
        for start, value in zip(b.column("start").to_pylist(), b.column("value").to_pylist())
    ]
    at, want = 0, []
    for line in data.decode().splitlines():
        want.append((at, line))
        at += len(line) + 1
    assert got == want


def test_lines_longer_than_a_block(tmp_path, monkeypatch):
    monkeypatch.setattr("residua.streaming.growing.BLOCK", 10)
    append(tmp_path, "a.log", b"a" * 35 + b"\n" + b"b" * 50 + b"\nc\n" + b"open" * 9)
    reader = GrowingReader({"path": str(tmp_path / "log"), "pieceBytes": "16"})
    end = reader.latestOffset()
    assert [v[0] for v in end.values()] == [89]
    values = [x for p in reader.partitions({}, end) for b in reader.read(p) for x in b.column("value").to_pylist()]
    assert values == ["a" * 35, "b" * 50, "c"]


def test_truncated_and_replaced_files(spark, tmp_path):
    append(tmp_path, "a.log", b"first\nsecond\n")
    run(spark, tmp_path)
    (tmp_path / "log" / "a.log").write_bytes(b"new\n")
    with pytest.raises(Exception, match="truncated or replaced"):
        run(spark, tmp_path)
    got = run(spark, tmp_path, truncated="restart")
    assert [v for _, _, v in got] == ["first", "new", "second"]
    # As long as before, but with another beginning.
    (tmp_path / "log" / "a.log").write_bytes(b"xyz\nmore\n")
    assert sorted(v for _, _, v in run(spark, tmp_path, truncated="restart")) == ["first", "more", "new", "second", "xyz"]


def test_metrics_of_a_growing_log(spark, tmp_path):
    def follow():
        follow_growing_metrics(
            spark, str(tmp_path / "log"), str(tmp_path / "table"), str(tmp_path / "state2")
        ).awaitTermination()
        return sorted(r.step for r in spark.read.parquet(str(tmp_path / "table")).where("step is not null").collect())

    append(tmp_path, "run.log", b"Epoch: 0, Step: 1.0, Training Loss: 1.5\nnoise\nEpoch: 0, Step: 2.0, Trai")
    assert follow() == [1]
    append(tmp_path, "run.log", b"ning Loss: 1.25\n")
    assert follow() == [1, 2]


def test_unknown_choice():
    with pytest.raises(ValueError):
        GrowingReader({"path": "x", "truncated": "ignore"})
