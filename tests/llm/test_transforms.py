import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F
from samples import SF, as_docs, bag, prose

from residua.llm import transforms as t
from residua.llm.queries import QUERIES, SQL

SMALL = t.Settings(window=24, symbol=4, gram=8)


def by_hand(rows, window):
    texts = [(i, (text or "").encode()) for i, text in rows]
    counts = Counter(x[p : p + window] for _, x in texts for p in range(len(x) - window + 1))
    out = []
    for i, x in texts:
        gone = np.zeros(len(x), bool)
        for p in range(len(x) - window + 1):
            if counts[x[p : p + window]] > 1:
                gone[p : p + window] = True
        kept = np.frombuffer(x, np.uint8)[~gone].tobytes()
        n_spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
        out.append((i, len(x), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def check(docs, settings):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = sorted((r[:5] for r in by_hand(rows, settings.window)), key=repr)
    assert bag(t.remove_repeated_bytes(docs, settings)) == want
    return want


def samples(seed=1):
    rng = random.Random(seed)
    base = "".join(rng.choice("abcdé ") for _ in range(4000))
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(0, 5)):
            a = rng.randrange(3900)
            parts.append(base[a : a + rng.randrange(1, 90)])
            parts.append("".join(rng.choice("xyz中\n") for _ in range(rng.randrange(0, 40))))
        rows.append((i, "".join(parts)))
    rows += [(100, "a" * 200), (101, "ab" * 60), (102, "ba" * 40 + "c"), (103, rows[5][1]), (104, None), (105, ""), (None, rows[6][1]), (6, rows[6][1])]
    # Windows of exactly the size, at both ends of texts.
    edge = "0123456789" * 2 + "wxyz"
    return rows + [(110, edge), (111, edge + "!"), (112, "!" + edge), (113, edge[1:] + "?")]


@pytest.mark.parametrize("settings", [
    SMALL, t.Settings(window=24, symbol=4, gram=16), t.Settings(window=24, symbol=8, gram=8, shard=60, run=300),
    t.Settings(window=24, symbol=24, gram=8), t.Settings(window=24, symbol=4, gram=8, group=1), t.Settings(window=25, symbol=5, gram=8, shard=40),
])
def test_small_windows(spark, settings):
    want = check(as_docs(spark, samples()), settings)
    assert any(0 < r[2] < r[1] for r in want)


def test_documents(documents):
    assert any(0 < r[2] < r[1] for r in check(documents, t.Settings()))


def test_edges(edges):
    check(edges, t.Settings())
    check(edges, SMALL)


def test_empty_table(no_docs):
    assert t.remove_repeated_bytes(no_docs).collect() == []
    assert t.without_repeated_bytes(no_docs).collect() == []


def test_partitions_and_strips_do_not_matter(spark, monkeypatch):
    docs = as_docs(spark, samples(2))
    want = bag(t.remove_repeated_bytes(docs.repartition(7), SMALL))
    assert bag(t.remove_repeated_bytes(docs.coalesce(1), SMALL)) == want
    data = ("abc" * 20 + prose(1, 200)).encode()
    text, offsets = np.frombuffer(data, np.uint8), np.array([0, 50, 51, len(data)])

    def starts():
        return sorted(
            (int(d), int(f) + i) for s in t.spans_of(text, offsets, SMALL) for d, f, n in zip(s.doc, s.first, s.n) for i in range(n)
        )

    whole = starts()
    assert whole == [(d, p) for d in range(3) for p in range(int(offsets[d + 1] - offsets[d]) - 23)]
    monkeypatch.setattr(t, "_STRIP", 37)
    assert starts() == whole


def test_hot_anchor_is_split(spark, conf, monkeypatch):
    # One line stands many times in many texts, so most spans have one of its few anchors.
    rng = random.Random(4)

    def noise(n):
        return "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))

    rows = [(i, "".join("The one line of them all. " + noise(rng.randrange(9) // 8) for _ in range(40)) + noise(40)) for i in range(80)]
    most = {}

    def stored(session, df, name):
        out = real(session, df, name)
        per_task = [r[1] for r in out.groupBy(F.input_file_name()).count().collect()] if name == "byte-hits" else []
        most[name] = (max(per_task, default=0), sum(per_task))
        return out

    real = t.stored
    monkeypatch.setattr(t, "stored", stored)
    for key, value in {
        "autoBroadcastJoinThreshold": "-1", "adaptive.advisoryPartitionSizeInBytes": "4k", "adaptive.coalescePartitions.enabled": "false",
        "adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }.items():
        conf(f"spark.sql.{key}", value)
    check(as_docs(spark, rows), t.Settings(window=24, symbol=4, gram=8, group=20))
    largest, total = most["byte-hits"]
    assert total > 2000 and largest < 0.25 * total


def test_without_repeated_bytes_keeps_rows_and_columns(spark):
    docs = as_docs(spark, samples())
    out = t.without_repeated_bytes(docs, SMALL)
    assert out.columns == docs.columns
    want = [(r[0], r[5]) for r in by_hand([tuple(r) for r in docs.select("doc_id", "text").collect()], 24)]
    assert sorted(((r.doc_id, bytes(r.text)) for r in out.collect()), key=repr) == sorted(want, key=repr)
    assert out.select("k", "tag", "row").distinct().collect()[0][0] == "k"


@pytest.mark.parametrize("n_shards", [1, 2, 5])
def test_merge_against_sorting_all_suffixes(n_shards):
    rng = random.Random(n_shards)
    depth = 4
    shards = [
        np.array([x for _ in range(rng.randrange(1, 6)) for x in [*(rng.randrange(3) for _ in range(rng.randrange(1, 15))), -1]])
        for _ in range(n_shards)
    ]
    place, common = t.merge([t.transform(s, depth) for s in shards], depth)
    suffixes = []
    for n, s in enumerate(shards):
        for i in t.transform(s, depth).suffix:
            stop = i + int(np.argmax(s[i:] < 0))
            # An empty suffix differs from all others and comes before all symbols.
            suffixes.append([*s[i:stop].tolist(), (-1, n, stop)][:depth])
    merged = [None] * len(suffixes)
    for p, s in zip(place.tolist(), suffixes):
        merged[p] = s
    as_key = [[(0, *x[1:]) if isinstance(x, tuple) else (1, x) for x in s] for s in merged]
    assert as_key == sorted(as_key)
    for p in range(1, len(merged)):
        a, b = merged[p - 1], merged[p]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common[p] == n


def test_query_matches_sql(spark):
    name = "op13_merged_transform_repeats"
    assert compare(QUERIES[name](spark, SF), connect(SF), SQL[name]) is None
