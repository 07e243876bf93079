import random

import pytest
from samples import bag

from residua.llm import graph
from residua.llm.graph import components


def by_hand(links):
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for v in sorted(near):
        if v not in out:
            todo = [v]
            while todo:
                x = todo.pop()
                if x not in out:
                    out[x] = v
                    todo += near[x]
    return sorted(out.items(), key=repr)


@pytest.mark.parametrize("last", [10_000, 5])
@pytest.mark.parametrize("kind", ["random", "path", "reversed path", "star", "stars"])
def test_components(spark, monkeypatch, kind, last):
    monkeypatch.setattr(graph, "LAST_LINKS", last)
    rng = random.Random(2)
    links = {
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(180)],
        "path": [(i, i + 1) for i in range(200)],
        "reversed path": [(-i, -i - 1) for i in range(200)],
        "star": [(500, i) for i in range(400)],
        "stars": [(i % 7 + 1000, i) for i in range(300)] + [(1000, 1003)],
    }[kind]
    links = [(a, b) for a, b in links if a != b]
    df = spark.createDataFrame(links + links[:5], "a bigint, b bigint")
    assert bag(components(df)) == by_hand(links)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
