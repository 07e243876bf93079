import hashlib
from collections import Counter

import numpy as np
import pytest
from samples import WORDS, as_docs, bag, prose

from residua.llm import substrings as s


def kept_words(rows, window=35):
    """Words that stay of each row, by counting all windows."""
    lists = [WORDS.findall(text or "") for _, text in rows]
    counts = Counter(tuple(w[p : p + window]) for w in lists for p in range(len(w) - window + 1))
    out = []
    for words in lists:
        keep = [True] * len(words)
        for p in range(len(words) - window + 1):
            if counts[tuple(words[p : p + window])] > 1:
                keep[p : p + window] = [False] * window
        out.append((words, [w for w, k in zip(words, keep) if k]))
    return out


def check(docs, settings=s.Settings()):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = [
        (i, len(words), len(words) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
        for (i, _), (words, kept) in zip(rows, kept_words(rows, settings.window))
    ]
    got = bag(s.remove_repeats(docs, settings))
    assert got == sorted(want, key=repr)
    return got


@pytest.mark.parametrize("group", [10_000, 2])
def test_documents(documents, group):
    got = check(documents, s.Settings(group=group))
    assert any(0 < r[2] < r[1] for r in got) and any(r[2] == 0 < r[1] for r in got)


@pytest.mark.parametrize("group", [10_000, 1])
def test_edges(edges, group):
    check(edges, s.Settings(group=group))


def test_empty_table(no_docs):
    assert s.remove_repeats(no_docs).collect() == []
    assert s.without_repeats(no_docs).collect() == []


def test_passages_at_every_place_and_periodic_texts(spark):
    passage = prose(1, 36)
    rows = [(i, " ".join([prose(100 + i, i), passage, prose(200 + i, 40 - i)])) for i in range(40)]
    rows += [(50, prose(300, 70) + " " + prose(300, 70)), (51, "a b c " * 40), (52, "a b c " * 30 + "d"), (53, "b c a " * 25)]
    rows += [(60 + i, " ".join(prose(400, 60).split()[i : i + 36])) for i in range(20)]
    check(as_docs(spark, rows))
    check(as_docs(spark, rows), s.Settings(group=3))


def test_partitions_do_not_matter(documents):
    assert bag(s.remove_repeats(documents.repartition(9))) == bag(s.remove_repeats(documents.coalesce(1)))


def test_without_repeats_keeps_rows_and_columns(edges):
    out = s.without_repeats(edges)
    assert out.columns == edges.columns and out.schema["text"].dataType == edges.schema["text"].dataType
    rows = [tuple(r) for r in edges.select("doc_id", "text").collect()]
    want = [
        (i, text if len(kept) == len(words) else " ".join(kept)) for (i, text), (words, kept) in zip(rows, kept_words(rows))
    ]
    got = [(i, t if t is None else " ".join(WORDS.findall(t))) for i, t in bag(out.select("doc_id", "text"))]
    assert sorted(got, key=repr) == sorted(((i, t if t is None else " ".join(WORDS.findall(t))) for i, t in want), key=repr)
    assert out.select("k", "tag", "row").distinct().collect()[0][0] == "k"
    # Texts without a repeat stay byte for byte.
    assert {i: t for i, t in rows}[13] == {i: t for i, t in out.select("doc_id", "text").collect()}[13]


def test_deep_nodes():
    words = np.array([1, 2, 3, 1, 2, 3, 1, 2, 4, 1], np.uint64)
    starts = np.arange(8)
    want = [sum((words[a : a + 3] == words[b : b + 3]).all() for b in starts) > 1 for a in starts]
    assert s.deep_nodes(words, starts, 3).tolist() == want
