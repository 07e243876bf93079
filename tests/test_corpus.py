import random

import pytest
from pyspark.sql import functions as F

from residua.functions.vocabulary import ESM2
from residua.operators.lookup import lookup_positions, with_global_index
from residua.plans import corpus, epochs, workspace
from residua.sources import read_index_map_folder, read_sequences_csv, read_shards

N = 40


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """FASTA text taken through every stage."""
    root = tmp_path_factory.mktemp("corpus")
    rng = random.Random(2)
    records = {f"P{i} n={i}": "".join(rng.choices(ESM2.letters[:20], k=rng.randrange(0, 70)))
               for i in range(400)}
    (root / "in.fasta").write_text("".join(f">{k}\n{v}\n" for k, v in records.items()))
    corpus.fasta_to_sequences(spark, str(root / "in.fasta"), str(root / "sequences"))
    sequences = spark.read.parquet(str(root / "sequences"))
    corpus.write_corpus(sequences, str(root / "corpus"), N, tasks=4, rows_per_file=30)
    corpus.write_index_maps(spark, str(root / "corpus"), str(root))
    return root, records, sequences


def split_of(spark, root, name):
    return read_shards(spark, f"{root}/corpus/split={name}")


def test_nothing_is_lost(spark, built):
    root, records, _ = built
    train, test = split_of(spark, root, "train"), split_of(spark, root, "test")
    names = [r.sequence_id for df in (train, test) for r in df.collect()]
    assert sorted(names) == sorted(records)
    assert train.count() > test.count() > 0
    for row in train.collect():
        length = min(len(records[row.sequence_id]), N - 2)
        assert sum(row.attention_mask) == length + 2 and len(row.input_ids) == N


def test_maps_lie_beside_the_shards(spark, built):
    root, *_ = built
    for name in corpus.SPLITS:
        shards = split_of(spark, root, name)
        files = read_index_map_folder(spark, str(root), f"{name}_index_map")
        assert files.agg(F.sum("num_sequences")).first()[0] == shards.count()
        ids = [r.global_idx for r in with_global_index(shards, files).collect()]
        assert sorted(ids) == list(range(len(ids)))
        found = lookup_positions(spark.range(5).toDF("idx"), files, shards, "binned", strict=True)
        assert found.where("input_ids is not null").count() == 5


def test_exact_file_counts(spark, built, tmp_path):
    _, records, sequences = built
    corpus.write_corpus_in_files(sequences, str(tmp_path / "c"), N, {"train": 6, "test": 2})
    rows = spark.read.parquet(str(tmp_path / "c"))
    assert rows.count() == len(records)
    files = rows.groupBy("split").agg(F.countDistinct("_metadata.file_name").alias("n"))
    assert {r.split: r.n for r in files.collect()} == {"train": 6, "test": 2}


def test_csv_between_the_stages(spark, built, tmp_path):
    root, records, _ = built
    corpus.fasta_to_sequences(spark, str(root / "in.fasta"), str(tmp_path / "csv"), as_csv=True)
    rows = read_sequences_csv(spark, str(tmp_path / "csv"))
    assert {r.sequence_id: r.sequence for r in rows.collect()} == records


def test_epoch_on_disk(spark, built, tmp_path):
    root, *_ = built
    shards = split_of(spark, root, "train")
    files = read_index_map_folder(spark, str(root), "train_index_map")
    samples = with_global_index(shards, files)
    before = {r.global_idx: r for r in samples.collect()}
    world, batch = 3, 8
    rows = epochs.epoch_samples(samples, world, batch, seed=5, epoch=1, batches_per_file=4, tasks=5)
    epochs.write_epoch(rows, str(tmp_path / "e"), 1)
    with pytest.raises(Exception, match="already exists"):
        epochs.write_epoch(rows, str(tmp_path / "e"), 1)
    written = spark.read.parquet(str(tmp_path / "e"))
    each = -(-len(before) // world)
    assert {r["rank"]: r["count"] for r in written.groupBy("rank").count().collect()} == {
        r: each for r in range(world)
    }
    for row in written.collect():
        source = before[row.global_idx]
        assert row.attention_mask == source.attention_mask and row.epoch == 1
        for x, y, label in zip(source.input_ids, row.input_ids, row.labels):
            assert (label == -100 and x == y) or label == x
    parts = written.groupBy(F.col("_metadata.file_path")).agg(F.countDistinct("rank").alias("n"))
    assert parts.where("n > 1").count() == 0


def test_files_for_one_split_only(spark, tmp_path):
    rows = spark.createDataFrame([("AC", "a")], "sequence string, sequence_id string")
    with pytest.raises(ValueError, match="file count"):
        corpus.write_corpus_in_files(rows, str(tmp_path / "c"), 9, {"train": 2})


class Session:
    """What the workspace asks of a session."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder(spark):
    given = workspace.new_path(Session("yarn", "hdfs://data/tmp/"), "a")
    assert given.startswith("hdfs://data/tmp/a-")
    local = workspace.shared_folder(Session("local[4]"))
    assert local == workspace.shared_folder(Session("local[4]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_folder(Session("yarn"))


def test_stored_table_has_no_lineage(spark):
    rows = workspace.stored(spark, spark.range(5), "kept")
    assert rows.count() == 5 and "Range" not in rows._jdf.queryExecution().toString()
