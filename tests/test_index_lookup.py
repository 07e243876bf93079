import pytest
from pyspark.sql import functions as F

from residua.operators import index, keyed, lookup
from residua.operators.split import spread_by_id, write_shards
from residua.schemas import INDEX_MAP
from residua.sources import index_file_path, read_index_map_folder, read_shard, read_shards


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """1,003 rows in files of 100, their map and their reader."""
    path = str(tmp_path_factory.mktemp("shards") / "train")
    rows = spark.range(1003).select(
        "id", F.array(F.col("id").cast("int"), F.lit(1)).alias("input_ids")
    )
    write_shards(spread_by_id(rows, "id", 100), path)
    shards = read_shards(spark, path)
    base = str(tmp_path_factory.mktemp("maps"))
    index.write_index_map(index.index_map(shards), f"{base}/train_index_map")
    return path, shards, base


def map_of(spark, sizes):
    names = [name for name, n in sizes.items() for _ in range(n)]
    rows = spark.createDataFrame([(n,) for n in names], "file_name string")
    return [tuple(r) for r in index.index_map(rows).orderBy("start_line").collect()]


def test_map_of_three_files(spark):
    assert map_of(spark, {"a": 3, "b": 1, "c": 2}) == [
        ("a", 3, 0, 2), ("b", 1, 3, 3), ("c", 2, 4, 5)
    ]
    assert map_of(spark, {"only": 4}) == [("only", 4, 0, 3)]


def test_map_tiles_the_rows(spark, data):
    _, _, base = data
    rows = read_index_map_folder(spark, base, "train_index_map").orderBy("start_line").collect()
    assert rows[0].start_line == 0 and rows[-1].end_line == 1002
    assert all(b.start_line == a.end_line + 1 for a, b in zip(rows, rows[1:]))
    assert all(r.end_line - r.start_line + 1 == r.num_sequences for r in rows)
    assert [r.file_name for r in rows] == sorted(r.file_name for r in rows)


def test_length_counts_the_last_row(spark, data):
    path, shards, base = data
    assert index.dataset_length(index.index_map(shards)).first().num_rows == 1003
    empty = spark.createDataFrame([], INDEX_MAP)
    assert index.dataset_length(empty).first().num_rows == 0


def test_map_reads_no_columns(spark, data, plan):
    path, _, _ = data
    text = plan(index.rows_per_file(read_shards(spark, path, columns=[])))
    assert "ReadSchema: struct<>" in text and "partial_count" in text


def test_folder_without_csv(spark, tmp_path):
    (tmp_path / "maps").mkdir()
    (tmp_path / "maps" / "note.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        index_file_path(spark, str(tmp_path), "maps")


def test_one_shard_opens_one_file(spark, data):
    path, shards, _ = data
    name = index.first_files(index.index_map(shards), 1).first().file_name
    rows = read_shard(spark, path, name)
    assert sorted(r.id for r in rows.collect()) == list(range(100))


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_global_index_is_dense(spark, data, conf, threshold):
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    _, shards, base = data
    files = read_index_map_folder(spark, base, "train_index_map")
    rows = lookup.with_global_index(shards, files).collect()
    assert sorted(r.global_idx for r in rows) == list(range(1003))
    assert all(r.global_idx == r.id for r in rows)


def test_map_in_several_files(spark, data, tmp_path):
    _, shards, _ = data
    index.write_index_map(index.index_map(shards).repartition(4), str(tmp_path / "m"))
    assert len(list((tmp_path / "m").glob("*.csv"))) > 1
    files = read_index_map_folder(spark, str(tmp_path), "m")
    assert files.count() == 11 and files.agg(F.sum("num_sequences")).first()[0] == 1003
    with pytest.raises(ValueError, match="several"):
        index_file_path(spark, str(tmp_path), "m")


def test_map_of_many_ranges_equals_one_running_total(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(5000).selectExpr("concat('f', id * id % 701) as file_name")
    got = index.index_map(rows).orderBy("file_name").collect()
    at = 0
    for r in got:
        assert (r.start_line, r.end_line) == (at, at + r.num_sequences - 1)
        at += r.num_sequences
    assert at == 5000 and [r.file_name for r in got] == sorted(r.file_name for r in got)


def test_equal_base_names(spark, tmp_path):
    """One task writes the same base name into every directory."""
    rows = spark.range(100).selectExpr("id", "if(id % 4 = 0, 'test', 'train') as split").coalesce(1)
    write_shards(rows, str(tmp_path / "a b"), by_split=True)
    shards = read_shards(spark, str(tmp_path / "a b"), ["id"])
    files = index.index_map(shards)
    assert files.count() == 2
    assert sorted(r.global_idx for r in lookup.with_global_index(shards, files).collect()) == list(range(100))
    name = files.orderBy("file_name").first().file_name
    assert name.startswith("split=test/")
    assert read_shard(spark, str(tmp_path / "a b"), name).count() == 25


def expected(requests):
    return sorted((n, i, i if 0 <= i < 1003 else None) for n, i in requests)


REQUESTS = [(n, i) for n, i in enumerate(
    [0, 99, 100, 1002, 1003, -1, 5000] + [77] * 400 + list(range(0, 1003, 9)) + [4000] * 60
)] + [(9, 5)] * 50


def make_large(conf):
    """Nothing is broadcast."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.mark.parametrize("strategy", ["dense", "binned"])
@pytest.mark.parametrize("large", [False, True])
def test_lookup_positions(spark, data, conf, strategy, large):
    _, shards, base = data
    if large:
        make_large(conf)
    files = read_index_map_folder(spark, base, "train_index_map")
    requests = spark.createDataFrame(REQUESTS, "n int, idx bigint")
    found = lookup.lookup_positions(requests, files, shards, strategy).collect()
    assert sorted(((r.n, r.idx, r.id) for r in found), key=str) == sorted(
        expected(REQUESTS), key=str)
    assert all(r.input_ids == [r.idx, 1] for r in found if r.id is not None)


@pytest.mark.parametrize("strategy", ["dense", "binned"])
def test_strict_lookup_fails(spark, data, strategy):
    _, shards, base = data
    files = read_index_map_folder(spark, base, "train_index_map")
    good = spark.createDataFrame([(1,), (1002,)], "idx bigint")
    bad = spark.createDataFrame([(1,), (1003,)], "idx bigint")
    assert lookup.lookup_positions(good, files, shards, strategy, strict=True).count() == 2
    with pytest.raises(Exception, match="no sample for 1003"):
        lookup.lookup_positions(bad, files, shards, strategy, strict=True).collect()


def test_unknown_strategy(spark, data):
    _, shards, base = data
    with pytest.raises(ValueError):
        lookup.lookup_positions(spark.range(1), index.index_map(shards), shards, "guess")


def test_locate(spark, data, plan):
    _, shards, _ = data
    requests = spark.createDataFrame(REQUESTS, "n int, idx bigint")
    found = lookup.locate(requests, index.index_map(shards))
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
    rows = found.collect()
    assert len(rows) == len(REQUESTS)
    for r in rows:
        inside = 0 <= r.idx < 1003
        assert r.local_row == (r.idx % 100 if inside else None)
        assert (r.file_name is not None) == inside


def test_locate_in_uneven_files(spark):
    """One huge file beside many small ones, empty files, and null positions."""
    sizes = [1] * 200 + [2 * 10**9] + [1] * 200 + [0, 7, 0, 300, 1]
    rows, at = [], 0
    for i, n in enumerate(sizes):
        rows.append((f"f{i:04}", n, at, at + n - 1))
        at += n
    files = spark.createDataFrame(rows, INDEX_MAP)
    wanted = [0, 199, 200, 2 * 10**9 + 199, 2 * 10**9 + 200, at - 1, at, -1, 10**9, None]
    found = lookup.locate(spark.createDataFrame([(i,) for i in wanted], "idx bigint"), files).collect()
    assert len(found) == len(wanted)
    for r in found:
        owner = [x for x in rows if r.idx is not None and x[2] <= r.idx <= x[3]]
        assert (r.file_name, r.local_row) == ((owner[0][0], r.idx - owner[0][2]) if owner else (None, None))


def test_no_job_runs_while_a_lookup_is_built(spark, data):
    path, shards, base = data
    files = read_index_map_folder(spark, base, "train_index_map")
    requests = spark.range(50).withColumnRenamed("id", "idx")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "lookups")
    for strategy in ("dense", "binned"):
        lookup.lookup_positions(requests, files, shards, strategy)
    lookup.lookup_keys(requests.withColumnRenamed("idx", "sequence_id"), items_of(spark, 9))
    assert tracker.getJobIdsForGroup("building") == []
    spark.sparkContext.setJobGroup("other", "")


def items_of(spark, n):
    samples = spark.range(n).select(
        "id", F.array(F.col("id").cast("int"), F.lit(2)).alias("input_ids"),
        F.array(F.lit(1), F.lit(1)).alias("attention_mask"),
    )
    return keyed.as_items(samples, "id")


@pytest.mark.parametrize("large", [False, True])
def test_lookup_keys(spark, conf, large):
    if large:
        make_large(conf)
    items = lookup.integer_items(items_of(spark, 50))
    requests = spark.createDataFrame(
        [(i,) for i in [3, 3, 49, 50]] + [(7,)] * 300 + [(None,)] * 90, "sequence_id bigint"
    )
    found = lookup.lookup_keys(requests, items).collect()
    assert len(found) == 394
    assert sum(r.input_ids == [7, 2] for r in found) == 300
    assert sum(r.input_ids is None for r in found) == 91
    with pytest.raises(Exception, match="no sample for 50"):
        lookup.lookup_keys(requests.dropna(), items, strict=True).collect()


def test_items_are_decimals(spark, tmp_path):
    keyed.write_items(items_of(spark, 5), str(tmp_path / "items"))
    stored = spark.read.parquet(str(tmp_path / "items"))
    assert dict(stored.dtypes)["input_ids"] == "array<decimal(38,0)>"
    row = lookup.integer_items(stored).where("sequence_id = 4").first()
    assert row.input_ids == [4, 2]
    assert lookup.model_columns(stored).columns == ["input_ids", "attention_mask"]


def test_bucketed_items_stay_where_they_are(spark, tmp_path, conf, plan):
    make_large(conf)
    keyed.write_bucketed_items(items_of(spark, 500), "kept_items", str(tmp_path / "b"), 4)
    requests = spark.range(900).withColumnRenamed("id", "sequence_id")
    joined = lookup.lookup_keys(requests, spark.table("kept_items"))
    item_side = plan(joined).split("SortMergeJoin")[1].split("kept_items")[0]
    between = item_side[item_side.rindex("Sort ["):]
    assert "Exchange" not in between and "Bucketed: true" in plan(joined)
    assert joined.where("input_ids is not null").count() == 500 and joined.count() == 900
    spark.sql("drop table kept_items")


def test_items_that_share_a_key(spark):
    items = lookup.integer_items(items_of(spark, 5).unionAll(items_of(spark, 5)))
    requests = spark.createDataFrame([(3,), (3,)], "sequence_id bigint")
    assert lookup.lookup_keys(requests, items, unique=False).count() == 2


def test_a_hot_request_is_split(spark, conf):
    """Adaptive execution cuts the partition of a position that many ask for."""
    make_large(conf)
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    files = spark.createDataFrame([("f", 40_000, 0, 39_999)], INDEX_MAP)
    requests = spark.range(120_000).selectExpr("if(id % 3 = 0, 5, id % 40000) as idx", "uuid() as u").repartition(8)
    found = lookup.locate(requests, files)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 120_000
    found.collect()
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
