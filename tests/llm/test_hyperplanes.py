import numpy as np
import pytest
from samples import SF, bag

from residua.llm import hyperplanes as h

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, cid bigint, usable int, bucket string"


def as_vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], l, "v", 1, 0, "b") for i, v, l in rows], SCHEMA)


def by_hand(rows, threshold=0.93):
    def usable(i, v, label):
        return i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [k for k, r in enumerate(rows) if usable(*r)]
    links = {k: set() for k in range(len(rows))}
    for a in good:
        for b in good:
            (_, x, one), (_, y, two) = rows[a], rows[b]
            if a != b and one == two and len(x) == len(y):
                x, y = np.array(x, float), np.array(y, float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links[a].add(b)
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        component = min(rows[b][0] for b in seen) if i is not None else None
        out.append((i, len(links[k]), component, i is None or i == component))
    return sorted(out, key=repr)


def clusters(seed=1, groups=30, dims=24):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for g in range(groups):
        centre = rng.normal(size=dims)
        for _ in range(int(rng.integers(1, 9))):
            rows.append((i, np.float32(centre + rng.normal(size=dims) * rng.choice([0, 0.05, 0.2, 0.4])).tolist(), g % 3))
            i += 1
    return rows


ODD = [
    (1000, None, 1), (1001, [], 1), (1002, [0.0] * 24, 1), (1003, [float("nan")] * 24, 1), (1004, [float("inf"), 1.0], 1),
    (1005, [None, 1.0], 1), (1006, [1.0, 2.0], None), (1007, [1.0, 2.0], 1), (1008, [2.0, 4.0], 1), (1009, [1.0, 2.0, 0.0], 1),
    (1010, [1.0, 2.0], 2), (None, [1.0, 2.0], 1), (1011, [1.0, 2.0], 1), (1011, [1.0, 2.0], 1), (1012, [-1.0, -2.0], 1),
    (1013, [1e30, 2e30], 1), (1014, [1e-30, 2e-30], 1), (1015, [-0.0, 1.0], 1), (1016, [0.0, 1.0], 1),
]


@pytest.mark.parametrize("block", [1024, 4])
def test_clusters_and_odd_vectors(spark, block):
    rows = clusters() + ODD
    want = by_hand(rows)
    got = bag(h.near_duplicates(as_vectors(spark, rows), h.Settings(block=block, miss=1e-6)))
    assert got == want
    assert sum(r[1] for r in want) > 50


def test_embeddings(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in vectors.collect()]
    assert bag(h.near_duplicates(vectors)) == by_hand(rows)


def test_recall_with_the_default_settings(spark):
    """Pairs right above the threshold, the hardest to find."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(400):
        x, y = rng.normal(size=(2, 32))
        x /= np.linalg.norm(x)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        cosine = rng.uniform(0.931, 0.95)
        rows += [(2 * k, x.tolist(), 0), (2 * k + 1, (cosine * x + np.sqrt(1 - cosine**2) * y).tolist(), 0)]
    got = {r[0]: r[1] for r in bag(h.near_duplicates(as_vectors(spark, rows)))}
    assert sum(got.values()) / 800 > 0.98


def test_empty_table(spark):
    assert h.near_duplicates(as_vectors(spark, [])).collect() == []


def test_tables_reach_the_recall():
    for largest in (1, 10**3, 10**6, 10**12):
        t = h.tables_for(largest)
        together = (1 - np.arccos(0.93) / np.pi) ** t.planes
        assert (1 - together) ** t.tables <= h.Settings().miss
