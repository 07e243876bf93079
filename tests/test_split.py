import pytest
from pyspark.sql import functions as F

from residua.operators.split import hash_split, random_split, spread_by_id, write_shards


def ids(spark, n=5000):
    return spark.range(n).withColumn("name", F.concat(F.lit("s"), F.col("id").cast("string")))


@pytest.mark.parametrize("key", ["id", "name"])
@pytest.mark.parametrize("hash", ["xxhash64", "md5"])
def test_sides_are_whole_disjoint_and_stable(spark, key, hash):
    rows = hash_split(ids(spark), key, 0.8, 1, hash)
    sides = {r.id: r.split for r in rows.collect()}
    assert len(sides) == 5000 and set(sides.values()) == {"train", "test"}
    assert 0.77 < sum(s == "train" for s in sides.values()) / 5000 < 0.83
    again = hash_split(ids(spark).repartition(17), key, 0.8, 1, hash)
    assert {r.id: r.split for r in again.collect()} == sides
    other = hash_split(ids(spark), key, 0.8, 2, hash)
    assert {r.id: r.split for r in other.collect()} != sides


def test_integer_width_does_not_matter(spark):
    long, short = ids(spark, 300), ids(spark, 300).withColumn("id", F.col("id").cast("int"))
    assert hash_split(long, "id").collect() == [
        r for r in hash_split(short, "id").withColumn("id", F.col("id").cast("bigint")).collect()
    ]


def test_split_is_a_projection(spark, plan):
    text = plan(hash_split(ids(spark), "id"))
    assert "Exchange" not in text and "Sort" not in text


def test_unknown_hash(spark):
    with pytest.raises(ValueError, match="unknown hash"):
        hash_split(ids(spark), "id", hash="sha")


def test_random_split_is_whole(spark):
    train, test = random_split(ids(spark), seed=3)
    assert train.count() + test.count() == 5000
    assert train.intersect(test).count() == 0


def sizes(spark, path):
    rows = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("f"))
    return [r.n for r in rows.agg(F.count("*").alias("n")).orderBy("f").collect()]


def test_file_counts(spark, tmp_path):
    write_shards(ids(spark), str(tmp_path / "even"), files=7)
    found = sizes(spark, str(tmp_path / "even"))
    assert len(found) == 7 and sum(found) == 5000 and max(found) - min(found) < 60
    write_shards(ids(spark).coalesce(2), str(tmp_path / "cap"), rows_per_file=400)
    assert max(sizes(spark, str(tmp_path / "cap"))) == 400


def test_copies_of_one_row_do_not_share_a_file(spark, tmp_path):
    copies = spark.range(900).select(F.lit("same").alias("name"))
    write_shards(copies, str(tmp_path / "s"), files=9)
    assert max(sizes(spark, str(tmp_path / "s"))) < 200


def test_dense_ids_fill_files_exactly(spark, tmp_path):
    write_shards(spread_by_id(ids(spark, 1050).repartition(5), "id", 100), str(tmp_path / "s"))
    assert sizes(spark, str(tmp_path / "s")) == [100] * 10 + [50]


def test_ordered_files(spark, tmp_path):
    write_shards(ids(spark).repartition(3), str(tmp_path / "s"), files=5, order_by="id")
    rows = spark.read.parquet(str(tmp_path / "s")).select(
        "id", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i")
    )
    assert [r.id for r in rows.orderBy("f", "i").collect()] == list(range(5000))


def test_one_directory_per_split(spark, tmp_path):
    write_shards(hash_split(ids(spark), "id"), str(tmp_path / "s"), by_split=True)
    train = spark.read.parquet(str(tmp_path / "s" / "split=train"))
    test = spark.read.parquet(str(tmp_path / "s" / "split=test"))
    assert train.count() + test.count() == 5000
    assert train.select("id").intersect(test.select("id")).count() == 0


def test_small_shares_are_honoured(spark):
    from residua.operators.split import split_threshold

    assert split_threshold(0.99999) < split_threshold(1.0) == 2**60
    sides = hash_split(spark.range(300_000), "id", 0.99999).groupBy("split").count().collect()
    assert {r["split"] for r in sides} == {"train", "test"}


def test_stored_alone_leaves_the_result_only(spark, tmp_path, monkeypatch):
    import os

    from residua.plans.workspace import new_path, stored, stored_alone

    monkeypatch.setattr("residua.plans.workspace.shared_folder", lambda spark: str(tmp_path / "shared"))
    before = new_path(spark, "before")

    def build():
        inner = stored(spark, spark.range(5), "inner")
        return stored_alone(spark, lambda: stored(spark, inner.where("id > 1"), "deep"), "middle")

    assert sorted(r.id for r in stored_alone(spark, build, "result").collect()) == [2, 3, 4]
    assert [name.split("-")[0] for name in os.listdir(tmp_path / "shared")] == ["result"]
    with pytest.raises(ZeroDivisionError):
        stored_alone(spark, lambda: stored(spark, spark.range(1), "lost").limit(1 // 0), "never")
    assert [name.split("-")[0] for name in os.listdir(tmp_path / "shared")] == ["result"]
    assert before
