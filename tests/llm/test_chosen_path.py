import random

import pytest
from samples import WORDS, as_docs, bag, prose

from residua.llm import chosen_path as c

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = WORDS.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def by_hand(rows, percent=85):
    """n_shingles, component and kept of each row by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    distinct = list(dict.fromkeys(s for (i, _), s in zip(rows, sets) if s and i is not None))
    name = {s: k for k, s in enumerate(distinct)}
    root = list(range(len(distinct)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = 0
    for a in range(len(distinct)):
        for b in range(a):
            both = len(distinct[a] & distinct[b])
            if 100 * both >= percent * (len(distinct[a]) + len(distinct[b]) - both):
                links += 1
                root[find(a)] = find(b)
    least = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            r = find(name[s])
            least[r] = min(least.get(r, i), i)
    out = []
    for (i, _), s in zip(rows, sets):
        component = least[find(name[s])] if s and i is not None else i
        out.append((i, len(s), component, i is None or component == i))
    return sorted(out, key=repr), links


def check(docs, settings=c.Settings()):
    want, links = by_hand([tuple(r) for r in docs.select("doc_id", "text").collect()], settings.percent)
    assert bag(c.near_duplicates(docs, settings)) == want
    return links


def variants(seed, n, words, edits):
    rng, base = random.Random(seed), prose(seed, words, 5000).split()
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_documents(documents):
    check(documents)


def test_edges(edges, no_docs):
    assert check(edges) >= 1
    assert c.near_duplicates(no_docs).collect() == []
    assert c.without_near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize("small", [32, 3])
def test_groups_of_near_copies_and_chains(spark, small):
    texts = [t for g in range(5) for t in variants(g, 20, 250, 6)]
    chain = prose(77, 200, 5000).split()
    for step in range(25):
        chain = chain[:]
        chain[8 * step % 200] = f"y{step}"
        texts.append(" ".join(chain))
    texts += [prose(500, 40) + " " + prose(600 + i, 12) for i in range(40)]
    docs = as_docs(spark, [((7 * i) % 1009, t) for i, t in enumerate(texts)])
    assert check(docs, c.Settings(small=small)) > 100


def test_all_levels_are_used(spark):
    texts = variants(5, 40, 300, 4)
    settings = c.Settings(small=2, first_levels=1, step=1, levels=2, trees=16)
    assert check(as_docs(spark, list(enumerate(texts))), settings) > 5


def test_one_row_of_each_component_stays(edges):
    out = c.without_near_duplicates(edges)
    assert out.columns == edges.columns
    rows = [tuple(r) for r in edges.select("doc_id", "text").collect()]
    want = set()
    components = {i: comp for i, _, comp, _ in by_hand(rows)[0]}
    for i, text in rows:
        if i is None or not shingle_set(text) or components[i] == i:
            want.add((i, text))
    got = bag(out.select("doc_id", "text"))
    assert set(got) == want
    plain = [r for r in got if r[0] is not None]
    assert len(plain) == len(set(plain))
    assert sum(r[0] is None for r in got) == 2


def test_threshold_is_exact(spark):
    words = [f"w{i}" for i in range(300)]
    rows = []
    for k in range(1, 12):
        copy = list(words)
        for j in range(k):
            copy[20 * j + 10] = f"z{k}-{j}"
        rows.append((k, " ".join(copy)))
    check(as_docs(spark, [(0, " ".join(words)), *rows]))


def test_tasks_hand_over_little_at_a_time(spark, monkeypatch):
    """Batches of long texts, and of pairs with their sets, stay small whatever the rows hold."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen = spark.conf.get(key), []
    inner = c.map_arrow

    def watched(df, schema, each):
        seen.append(df.sparkSession.conf.get(key))
        return inner(df, schema, each)

    monkeypatch.setattr(c, "map_arrow", watched)
    docs = as_docs(spark, list(enumerate(variants(3, 60, 400, 4))))
    c.without_near_duplicates(docs)
    assert check(docs) > 50
    assert set(seen) == {"4m"} and spark.conf.get(key) == before
