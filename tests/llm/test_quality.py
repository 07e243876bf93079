import zlib

import numpy as np
import pytest
from samples import as_docs, prose

from residua.llm import quality as q

LABELS = "doc_id bigint, quality int, toxic int, x string"


def test_held_out_accuracy(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    rows = q.classify(docs, labels).join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"] and r["quality"] is not None]
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.95


def test_edges(spark, edges, no_docs):
    labels = spark.createDataFrame([(1, 1, 0, ""), (2, 1, 0, ""), (12, 0, 0, ""), (19, 0, 0, ""), (None, 1, 0, ""), (3, None, 0, ""), (7, 5, 0, "")], LABELS)
    rows = q.classify(edges, labels).collect()
    assert len(rows) == edges.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (4, 5)}) == 1
    assert q.classify(no_docs, labels).collect() == []


def test_labels_that_cannot_teach(spark, edges):
    none = spark.createDataFrame([], LABELS)
    assert {(r["score"], r["predicted"]) for r in q.classify(edges, none).collect()} == {(1.0, 1)}
    bad = spark.createDataFrame([(1, 0, 0, ""), (3, 0, 0, "")], LABELS)
    assert {(r["score"], r["predicted"]) for r in q.classify(edges, bad).collect()} == {(0.0, 0)}


def test_normal_equations_against_one_solve(spark):
    """The sums of all tasks give the weights that one matrix of all rows gives."""
    texts = [prose(i, 60) if i % 3 else "JUNK!! " * (20 + i) for i in range(90)]
    docs = as_docs(spark, list(enumerate(texts))).repartition(7)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0, "") for i in range(90)], LABELS)
    settings = q.Settings(n_features=40, ridge=1.0)
    model = q.fit(docs, labels, settings)
    import pyarrow as pa

    z = q._kernel(q._described(pa.array(texts)), model)
    y = np.array([i % 3 > 0 for i in range(90)], float)
    want = np.linalg.solve(z.T @ z + settings.ridge * 90 * np.eye(41) / 41, z.T @ y)
    assert np.allclose(model.weights, want, atol=1e-6)


def test_kernel_is_gaussian():
    rng = np.random.default_rng(0)
    model = q.Model(np.zeros(5), np.ones(5), None, np.zeros(0), q.Settings(n_features=20_000, width=0.5))
    x = rng.normal(size=(6, 5))
    z = q._kernel(x, model)[:, :-1]
    want = np.exp(-0.5 * 0.25 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - want).max() < 0.05


@pytest.mark.parametrize("seed", range(5))
def test_isotonic_fit(seed):
    rng = np.random.default_rng(seed)
    n = rng.integers(0, 5, 40).astype(float)
    p = np.minimum(n, rng.integers(0, 5, 40)).astype(float)
    levels = q.pool(p, n)
    assert (np.diff(levels) >= -1e-12).all()
    # The fit keeps the mean: pools are averages.
    centres = []
    for cell in np.flatnonzero(n):
        value, weight = p[cell] / n[cell], n[cell]
        while centres and centres[-1][0] >= value:
            v, w = centres.pop()
            value, weight = (v * w + value * weight) / (w + weight), w + weight
        centres.append((value, weight))
    assert sum(v * w for v, w in centres) == pytest.approx(p.sum())
    assert min(v for v, _ in centres) == pytest.approx(levels.min()) and max(v for v, _ in centres) == pytest.approx(levels.max())
