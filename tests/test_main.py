import pytest

from residua.__main__ import main


def test_stages_in_a_row(spark, tmp_path):
    (tmp_path / "in.fasta").write_text("".join(f">P{i}\n{'ACDEF' * (i % 9)}\n" for i in range(120)))
    path = {n: str(tmp_path / n) for n in ("in.fasta", "seq", "csv", "corpus", "files", "maps", "epoch")}
    main(["sequences", "--input_path", path["in.fasta"], "--output_path", path["seq"]])
    main(["sequences", "--input_path", path["in.fasta"], "--output_path", path["csv"], "--csv"])
    main(["tokenise", "--input_path", path["seq"], "--output_path", path["corpus"],
          "--sequence_length", "20", "--tasks", "3"])
    main(["tokenise", "--input_path", path["csv"], "--output_path", path["files"], "--csv",
          "--sequence_length", "20", "--train_files", "4", "--test_files", "1"])
    key = ["sequence_id", "input_ids"]
    one, two = (spark.read.parquet(path[n]).select("split", *key) for n in ("corpus", "files"))
    assert one.count() == 120 and one.exceptAll(two).count() == 0
    main(["index", "--input_path", path["corpus"], "--output_path", path["maps"]])
    for epoch in ("0", "1"):
        main(["epoch", "--input_path", path["corpus"], "--output_path", path["epoch"],
              "--index_path", path["maps"], "--world_size", "4",
              "--batch_size", "8", "--tasks", "2", "--epoch", epoch])
    main(["epoch", "--input_path", path["corpus"], "--output_path", path["epoch"] + "-test", "--split", "test",
          "--index_path", path["maps"], "--world_size", "2", "--batch_size", "8", "--tasks", "1", "--epoch", "7"])
    test = one.where("split = 'test'").count()
    assert spark.read.parquet(path["epoch"] + "-test").where("epoch = 0").count() == -(-test // 2) * 2
    with pytest.raises(SystemExit):
        main(["tokenise", "--input_path", path["seq"], "--output_path", path["corpus"] + "2",
              "--sequence_length", "20", "--train_files", "4"])
    train = one.where("split = 'train'").count()
    rows = spark.read.parquet(path["epoch"])
    assert {r["epoch"]: r["count"] for r in rows.groupBy("epoch").count().collect()} == {
        0: -(-train // 4) * 4, 1: -(-train // 4) * 4
    }
