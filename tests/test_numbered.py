import glob
import os

import pytest
from pyspark.sql import functions as F

from residua.operators import index, keyed, lookup, numbered
from residua.operators.split import file_sizes, measured_ratio, write_shards, write_shards_of_size
from residua.plans.sizing import spread_if_narrow
from residua.queries import corpus, standins
from residua.sources import read_shards

N, B = 1003, 100


@pytest.fixture
def path(spark, tmp_path):
    out = str(tmp_path / "numbered")
    rows = spark.range(N, numPartitions=5).select(F.col("id").alias("global_idx"), (F.col("id") * 3).alias("value"))
    numbered.write_numbered(rows.orderBy(F.rand(1)), out, B, tasks=4)
    return out


def spoil(files):
    for name in files:
        with open(name, "r+b") as file:
            file.write(b"spoilt " * 100)
        crc = os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


def test_numbers_are_places_on_disk(spark, path, plan):
    rows = numbered.read_numbered(spark, path)
    assert sorted(tuple(r) for r in rows.select("global_idx", "value", "block").collect()) == [(i, 3 * i, i // B) for i in range(N)]
    assert len(glob.glob(f"{path}/rows={B}/block=*/*.parquet")) == 11
    text = plan(rows.select("global_idx"))
    assert "Exchange" not in text and "Join" not in text and "ReadSchema: struct<_tmp_metadata_row_index:bigint>" in text
    assert numbered.rows_per_block_of(spark, path) == B


@pytest.mark.parametrize("ids", [[1, 2], [0, 2], [0, 0, 1], [None, 0], [0, 1, 1, 3]])
def test_numbers_must_be_dense(spark, tmp_path, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "global_idx long").withColumn("x", F.lit(1))
    with pytest.raises(ValueError):
        numbered.write_numbered(rows, str(tmp_path / "n"), 2)


def test_empty(spark, tmp_path):
    rows = spark.createDataFrame([], "global_idx long, value long")
    numbered.write_numbered(rows, str(tmp_path / "n"), 2)


@pytest.mark.parametrize("asked", [[5, 7, 5, 999, 1003, -1, None, 205, 10**12], list(range(N)) * 2, []])
def test_lookup(spark, path, asked):
    requests = spark.createDataFrame([(i, str(n)) for n, i in enumerate(asked)], "idx long, tag string")
    found = numbered.lookup_numbered(requests, numbered.read_numbered(spark, path), B)
    want = [(i, str(n), 3 * i if i is not None and 0 <= i < N else None) for n, i in enumerate(asked)]
    assert found.columns == ["idx", "tag", "value"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(want, key=repr)


def test_strict_lookup(spark, path):
    requests = spark.createDataFrame([(5,), (N,)], "idx long")
    with pytest.raises(Exception, match="no sample"):
        numbered.lookup_numbered(requests, numbered.read_numbered(spark, path), B, strict=True).collect()


def test_only_blocks_asked_for_are_opened(spark, path, tmp_path, plan):
    """Ten requests in two blocks: the files of the other nine may be unreadable."""
    shards = numbered.read_numbered(spark, path)
    asked = str(tmp_path / "asked")
    spark.createDataFrame([(i,) for i in [*range(205, 210), *range(700, 705)]], "idx long").write.parquet(asked)
    requests = spark.read.parquet(asked)
    spoil(f for f in glob.glob(f"{path}/rows={B}/block=*/*.parquet") if "block=2/" not in f and "block=7/" not in f)
    found = numbered.lookup_numbered(requests, shards, B)
    assert sorted(r.value for r in found.collect()) == [3 * i for i in [*range(205, 210), *range(700, 705)]]
    assert "dynamicpruning" in plan(found)
    with pytest.raises(Exception):
        shards.agg(F.sum("value")).collect()


@pytest.fixture
def items(spark, tmp_path):
    rows = spark.range(200).select(
        F.col("id").alias("sequence_id"), F.array(F.col("id").cast("decimal(38,0)")).alias("input_ids"),
        F.array(F.lit(1).cast("decimal(38,0)")).alias("attention_mask"),
    )
    name = "items_of_test_numbered"
    keyed.write_bucketed_items(rows, name, str(tmp_path / "items"), 16)
    yield spark.table(name)
    spark.sql(f"DROP TABLE {name}")


def test_items_stay_in_their_buckets(spark, items, conf, plan):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    requests = spark.range(300).select(F.col("id").alias("sequence_id"))
    found = lookup.lookup_keys(requests, lookup.integer_items(items))
    assert found.where("input_ids is not null").count() == 200
    # One exchange, that of the requests.
    text = plan(found)
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text


def test_few_keys_read_their_buckets_only(spark, items, tmp_path):
    keys = spark.createDataFrame([(3,), (3,), (None,), (777,)], "sequence_id long")
    found = keyed.items_of_keys(items, keys)
    folder = str(tmp_path / "items")
    holders = {r.name for r in items.where("sequence_id in (3, 777)").select(F.col("_metadata.file_name").alias("name")).collect()}
    assert len(holders) == 1
    wanted = {f.rsplit("_", 1)[1][:5] for f in holders}
    for other in (777,):
        wanted |= {f"{spark.range(1).select(F.pmod(F.hash(F.lit(other).cast('bigint')), F.lit(16))).first()[0]:05d}"}
    spoil(f for f in glob.glob(f"{folder}/*.parquet") if f.rsplit("_", 1)[1][:5] not in wanted)
    assert [r.sequence_id for r in found.collect()] == [3]
    with pytest.raises(ValueError):
        keyed.items_of_keys(items, keys, most=1)


def test_extended_map_opens_new_files_only(spark, tmp_path):
    path = str(tmp_path / "odd näme") + "=1"
    write_shards(spark.range(50).repartition(3), f"{path}/day=a")
    known = index.index_map(read_shards(spark, path, []))
    first = [tuple(r) for r in known.collect()]
    known = spark.createDataFrame(first, known.schema)
    assert sorted(tuple(r) for r in index.extended_index_map(spark, known, path).collect()) == sorted(first)
    write_shards(spark.range(70).repartition(4), f"{path}/day=b")
    full = sorted(tuple(r) for r in index.index_map(read_shards(spark, path, [])).collect())
    spoil(glob.glob(f"{path}/day=a/*.parquet"))
    got = index.extended_index_map(spark, known, path)
    assert sorted(tuple(r) for r in got.collect()) == full and got.columns == known.columns
    empty = spark.createDataFrame([], known.schema)
    write_shards(spark.range(7), str(tmp_path / "new"))
    assert [r.end_line for r in index.extended_index_map(spark, empty, str(tmp_path / "new")).collect()][-1] == 6
    with pytest.raises(ValueError, match="is gone"):
        index.extended_index_map(spark, known, str(tmp_path / "new"))


@pytest.mark.parametrize("keys", [(), ("hot",)])
def test_files_of_a_target_size(spark, tmp_path, conf, keys):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    rows = spark.range(200_000, numPartitions=16).select("id", F.xxhash64("id").alias("x"), F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 7).alias("hot"))
    ratio, target = 1.0, 300_000
    for n in range(2):
        path = str(tmp_path / f"sized{n}")
        write_shards_of_size(rows, path, target, ratio, keys)
        ratio = measured_ratio(spark, path, target, ratio)
    sizes = [r.bytes for r in file_sizes(spark, path).collect()]
    assert len(sizes) > 3 and all(target / 2 <= s <= 2 * target for s in sizes)
    assert spark.read.parquet(path).count() == 200_000
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before


def test_files_of_the_query_do_not_grow_with_the_table(spark, monkeypatch):
    """What is asked for is bounded, and a hot key of a table of one file is split to that size."""
    most, asked, largest = 1_200_000, [], []
    write = write_shards_of_size

    def watched(rows, path, target, *rest):
        write(rows, path, target, *rest)
        asked.append(target)
        largest.append(max(r.bytes for r in file_sizes(spark, path).collect()))

    monkeypatch.setattr(corpus, "MOST_BYTES", most, raising=False)
    monkeypatch.setattr(corpus.split, "write_shards_of_size", watched)
    rows = corpus.target_bytes(standins.Tables(spark, "/root/testdata/sf0.1")).collect()
    assert max(asked) <= most and max(largest) <= 2 * most
    assert sorted((r.kind, r.rows, r.several) for r in rows) == [("even", 600_000, True), ("hot", 600_000, True)]


def test_large_files_go_to_more_tasks(spark, tmp_path, conf):
    """One file: the tasks grow with its splits, not with the cores alone."""
    path = str(tmp_path / "one")
    spark.range(300_000).coalesce(1).select(F.xxhash64("id").alias("x")).write.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    assert spread_if_narrow(spark.read.parquet(path)).rdd.getNumPartitions() == cores
    conf("spark.sql.files.maxPartitionBytes", "100k")
    spread = spread_if_narrow(spark.read.parquet(path))
    assert spread.rdd.getNumPartitions() > 4 * cores and spread.count() == 300_000
