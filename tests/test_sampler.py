import pytest
from pyspark.sql import functions as F

from residua.operators import sampler


def assign(spark, n, world, batch=3, parts=3, **options):
    rows = spark.range(n, numPartitions=parts)
    return sampler.epoch_assignment(rows, world, batch, **options)


@pytest.mark.parametrize("n, world", [(3, 8), (1, 4), (8, 8), (17, 4), (1000, 3), (24, 5)])
@pytest.mark.parametrize("shuffle", [True, False])
def test_every_rank_gets_as_much(spark, n, world, shuffle):
    rows = assign(spark, n, world, seed=1, shuffle=shuffle).collect()
    each = -(-n // world)
    assert sorted(r.pos for r in rows) == list(range(each * world))
    assert {r.id for r in rows} == set(range(n))
    first = {r.pos: r.id for r in rows if r.pos < n}
    for r in rows:
        assert r.id == first[r.pos % n]
        assert r.rank == r.pos % world and r.rank_pos == r.pos // world
        assert r.batch == r.rank_pos // 3
    if not shuffle:
        assert all(first[p] == p for p in first)


def order(spark, **options):
    rows = assign(spark, 500, 4, **options).collect()
    return [r.id for r in sorted(rows, key=lambda r: r.pos)]


def test_order_depends_on_seed_and_epoch_only(spark):
    base = order(spark, seed=1, epoch=2)
    assert base == order(spark, seed=1, epoch=2, parts=11)
    assert base == order(spark, seed=1, epoch=2, bucket_bits=3)
    assert base == order(spark, seed=1, epoch=2, bucket_bits=0)
    assert base != order(spark, seed=1, epoch=3)
    assert base != order(spark, seed=2, epoch=2)
    assert base != list(range(500))


def test_order_is_mixed(spark):
    """Neighbours in the data are far apart in the epoch."""
    places = order(spark, seed=3)
    moved = sum(abs(i - p) for i, p in enumerate(places)) / 500
    assert 120 < moved < 210


def test_text_ids(spark):
    rows = spark.range(40).select(F.concat(F.lit("s"), "id").alias("name"))
    out = sampler.epoch_assignment(rows, 4, 2, id_col="name").collect()
    assert len({r.name for r in out}) == 40 and sorted(r.pos for r in out) == list(range(40))


def test_other_columns_travel_along(spark):
    rows = spark.range(20).withColumn("payload", F.col("id") * 2)
    out = sampler.epoch_assignment(rows, 3, 2).collect()
    assert len(out) == 21 and all(r.payload == 2 * r.id for r in out)


def test_packed_batches(spark):
    rows = assign(spark, 50, 4, batch=4, seed=2)
    packed = sampler.packed_batches(rows, ["id"]).collect()
    flat = {(p.rank, s.rank_pos): s.id for p in packed for s in p.samples}
    assert flat == {(r.rank, r.rank_pos): r.id for r in rows.collect()}
    assert all([s.rank_pos for s in p.samples] == sorted(s.rank_pos for s in p.samples) for p in packed)
    assert {len(p.samples) for p in packed} == {4, 1}
    counts = {r.rank: r.num_batches for r in sampler.batches_per_rank(rows).collect()}
    assert counts == {0: 4, 1: 4, 2: 4, 3: 4}


def test_no_global_sort(spark, plan, conf):
    """One shuffle by bucket for the rows; only the bucket counts meet in one task."""
    conf("spark.sql.adaptive.enabled", "false")
    rows = spark.range(1000).withColumn("payload", F.lit("x"))
    text = plan(sampler.epoch_assignment(rows, 4, 2))
    assert "rangepartitioning" not in text
    single = text[text.index("Exchange SinglePartition"):]
    assert "payload" not in single and "partial_count" in single


def test_offsets_are_bounded(spark):
    with pytest.raises(ValueError):
        sampler.epoch_assignment(spark.range(3), 2, 1, bucket_bits=21)


@pytest.mark.parametrize("ids", [[1, 2, 4], [0, 0, 1], [0, None]])
def test_unshuffled_ids_are_checked(spark, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "id bigint")
    with pytest.raises(Exception, match="not dense and unique"):
        sampler.epoch_assignment(rows, 2, 2, shuffle=False).collect()


def test_unshuffled_ids_may_begin_anywhere(spark):
    rows = spark.createDataFrame([(i,) for i in range(5, 10)], "id bigint")
    placed = sampler.epoch_assignment(rows, 2, 2, shuffle=False)
    assert sorted(r.pos for r in placed.collect()) == [0, 1, 2, 3, 4, 5]
    assert sorted((r.id, r.pos) for r in placed.collect())[0] == (5, 0)


def test_packed_batches_keep_epochs_apart(spark):
    one = sampler.epoch_assignment(spark.range(10), 2, 2, epoch=0).withColumn("epoch", F.lit(0))
    two = sampler.epoch_assignment(spark.range(10), 2, 2, epoch=1).withColumn("epoch", F.lit(1))
    packed = sampler.packed_batches(one.unionAll(two), ["id"]).collect()
    assert all(len(r.samples) <= 2 for r in packed) and len(packed) == 12


@pytest.mark.parametrize("n, world", [(1, 4), (2, 3), (3, 8), (8, 8), (17, 4), (24, 5), (1000, 3), (4099, 7)])
def test_bijection_gives_every_rank_as_much(spark, n, world):
    rows = sampler.bijective_assignment(spark.range(n, numPartitions=3), world, 3, 5, 2, "id").collect()
    each = -(-n // world)
    assert sorted(r.pos for r in rows) == list(range(each * world))
    first = {r.pos: r.id for r in rows if r.pos < n}
    assert sorted(first.values()) == list(range(n))
    for r in rows:
        assert r.id == first[r.pos % n] and (r.rank, r.rank_pos, r.batch) == (r.pos % world, r.pos // world, r.pos // world // 3)


def test_bijection_is_a_projection(spark, plan):
    rows = sampler.bijective_assignment(spark.range(1000).withColumn("payload", F.col("id") * 2), 4, 3, 1, 1, "id", rows=1000)
    text = plan(rows)
    assert not any(word in text for word in ("Exchange", "Join", "Sort", "Window"))
    places = {r.pos: r.id for r in rows.collect()}
    assert all(r.payload == 2 * r.id for r in rows.collect())
    moved = sum(abs(i - p) for p, i in places.items()) / 1000
    assert 280 < moved < 390
    other = sampler.bijective_assignment(spark.range(1000), 4, 3, 1, 2, "id", rows=1000)
    assert {r.pos: r.id for r in other.collect()} != places


@pytest.mark.parametrize("ids", [[5], [-1, 0], [0, 1, 9]])
def test_bijection_refuses_numbers_beyond_the_rows(spark, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "id long")
    with pytest.raises(Exception, match="below the row count"):
        sampler.bijective_assignment(rows, 2, 2, id_col="id").collect()


def test_bijective_epoch_moves_token_arrays_once(spark, plan):
    from residua.plans.epochs import epoch_samples

    ids = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda x: (x + 4).cast("int"))
    samples = spark.range(100).select(F.col("id").alias("global_idx"), ids.alias("input_ids"), F.transform(ids, lambda x: F.lit(1)).alias("attention_mask"))
    rows = epoch_samples(samples, 4, 5, 1, 0, batches_per_file=2, tasks=3, order="bijection", rows=100)
    assert plan(rows).count("Exchange") == 1
    assert sorted(r.global_idx for r in rows.collect()) == list(range(100))
    with pytest.raises(ValueError):
        epoch_samples(samples, 4, 5, order="other")
