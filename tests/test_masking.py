import random
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from residua.functions import hashing
from residua.functions.vocabulary import ESM2
from residua.operators.masking import mask_tokens
from residua.operators.tokenize import tokenize


@pytest.fixture(scope="module")
def samples(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices(ESM2.letters[:20], k=rng.randrange(20, 200))) for _ in range(800)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, sequence string")
    return tokenize(rows, 100).drop("sequence").cache()


def pairs(samples, masked):
    before = {r.id: r.input_ids for r in samples.collect()}
    return [(before[r.id], r.input_ids, r.labels) for r in masked.collect()]


def test_labels_and_inputs_fit(samples):
    special = set(ESM2.special_ids)
    outcomes = Counter()
    for ids, inputs, labels in pairs(samples, mask_tokens(samples, "id", seed=3)):
        assert len(ids) == len(inputs) == len(labels) == 100
        for x, y, label in zip(ids, inputs, labels):
            if label == -100:
                assert x == y
                outcomes["special" if x in special else "left"] += 1
            else:
                assert label == x and x not in special
                outcomes["mask" if y == ESM2.mask_id else "same" if y == x else "other"] += 1
    chosen = outcomes["mask"] + outcomes["same"] + outcomes["other"]
    assert abs(chosen / (chosen + outcomes["left"]) - 0.15) < 0.006
    assert abs(outcomes["mask"] / chosen - 0.803) < 0.02
    assert abs(outcomes["other"] / chosen - 0.094) < 0.015
    assert abs(outcomes["same"] / chosen - 0.103) < 0.015


def test_random_tokens_cover_the_vocabulary(samples):
    seen = Counter()
    for epoch in range(4):
        for ids, inputs, labels in pairs(samples, mask_tokens(samples, "id", epoch=epoch)):
            seen.update(y for x, y, label in zip(ids, inputs, labels) if y != x)
    assert set(seen) == set(range(33))


@pytest.mark.parametrize("probability", [0, 1, 0.5])
def test_probability(samples, probability):
    rows = mask_tokens(samples, "id", probability)
    eligible, chosen = 0, 0
    for ids, _, labels in pairs(samples, rows):
        eligible += sum(x not in ESM2.special_ids for x in ids)
        chosen += sum(label != -100 for label in labels)
    assert abs(chosen / eligible - probability) < 0.01


def test_choices_depend_on_seed_epoch_and_id_only(samples):
    def run(df, **options):
        rows = mask_tokens(df, "id", **options).orderBy("id").collect()
        return [(r.input_ids, r.labels) for r in rows]

    base = run(samples, seed=1, epoch=0)
    assert base == run(samples.repartition(7), seed=1, epoch=0)
    assert base == run(samples.withColumn("id", F.col("id").cast("int")), seed=1, epoch=0)
    assert base == run(samples, seed=1, epoch=F.lit(0))
    assert base != run(samples, seed=2, epoch=0)
    assert base != run(samples, seed=1, epoch=1)


def test_draws_are_the_published_hash(spark):
    """Row and position hashes against an independent implementation."""
    def longs(*values):
        state = 42
        for v in values:
            state = xxhash.xxh64_intdigest(struct.pack("<q", v), state)
        return state

    rows = spark.range(200).withColumn("h", hashing.seeded_hash(7, F.col("id"))).collect()
    assert all(r.h == longs(7, r.id) >> 4 for r in rows)
    assert all(0 <= r.h < 2**hashing.HASH_BITS for r in rows)


def test_replacements_are_drawn_once(samples, plan):
    """Both results read them, so they must not be copied into each."""
    text = plan(mask_tokens(samples.select("id", "input_ids"), "id")).split("InMemory")[0]
    assert text.count("transform(") == 1 and text.count("zip_with(") == 2
    assert "Python" not in text and "Exchange" not in text


@pytest.mark.parametrize("kept", ["input_ids", "labels"])
def test_no_array_is_computed_per_element(samples, plan, kept):
    """With one result dropped, the replacements are an argument, not part of a lambda."""
    text = plan(mask_tokens(samples.select("id", "input_ids"), "id").select(kept))
    outer = text.split("InMemory")[0].split("zip_with(")[1]
    last_lambda = outer[outer.rindex("lambdafunction("):]
    assert "transform(" in outer and "xxhash64" not in last_lambda
