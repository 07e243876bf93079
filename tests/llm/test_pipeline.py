import corpus_pipeline as p
from samples import SF, as_docs, bag, edge_texts
from test_chosen_path import by_hand, shingle_set
from test_substrings import kept_words

from residua.llm import quality, surrogates
from residua.plans.workspace import stored


def test_stages_against_plain_versions(spark, documents):
    """Each stage on its own input, as its predecessor left it."""
    assert [n for n, _ in p.STAGES] == ["quality", "near_duplicates", "substrings", "personal_data", "packing"]
    docs = documents
    for name, stage in p.STAGES:
        out = stored(spark, stage(spark, docs, SF), name)
        before, after = ([tuple(r) for r in df.collect()] for df in (docs, out))
        if name != "packing":
            assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        if name == "quality":
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            good = {r["doc_id"] for r in quality.classify(docs, labels).where("predicted = 1").collect()}
            assert sorted(after) == sorted(r for r in before if r[0] in good) and 0 < len(after) < len(before)
        elif name == "near_duplicates":
            kept = {i for i, n, _, kept in by_hand([r[:2] for r in before])[0] if kept}
            assert sorted(after) == sorted(r for r in before if r[0] in kept)
        elif name == "substrings":
            want = {i: words for (i, *_), (_, words) in zip(before, kept_words([r[:2] for r in before]))}
            assert {r[0]: r[1].split() for r in after} == want
        elif name == "personal_data":
            assert [len(surrogates.mentions(r[1])) for r in sorted(before)] == [len(surrogates.mentions(r[1])) for r in sorted(after)]
            assert not {(m.kind, m.value) for r in before for m in surrogates.mentions(r[1])} & {(m.kind, m.value) for r in after for m in surrogates.mentions(r[1])}
        else:
            assert {r[0] for r in after} == {r[0] for r in before}
        docs = out


def test_run(spark):
    out = p.run(spark, SF)
    assert out.count() > 0 and out.columns[:3] == ["doc_id", "start", "length"]


def test_edges_through_all_stages(spark, edges, no_docs):
    for docs in (edges, no_docs):
        for name, stage in p.STAGES:
            docs = stored(spark, stage(spark, docs, SF), name)
            if name != "packing":
                assert docs.columns == edges.columns


def test_rows_that_repeat(spark):
    docs = as_docs(spark, [*edge_texts(), *edge_texts()])
    kept = bag(p.near_duplicates(spark, docs, SF).select("doc_id", "text"))
    assert len([r for r in kept if r[0] is not None and shingle_set(r[1])]) == len({r for r in kept if r[0] is not None and shingle_set(r[1])})


def test_stages_hand_little_to_few_processes(spark, documents, conf, plan):
    """Batches are small when a stage's rows are computed, and no task has two Python steps."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    for name, stage in p.STAGES:
        conf(key, "64m")
        out = stage(spark, documents, SF)
        assert spark.conf.get(key) == "4m", name
        # The first plan, top down: between two Python steps of a branch lies an exchange.
        python = {}
        for line in plan(out).split("Initial Plan")[0].splitlines():
            depth = len(line) - len(line.lstrip(" :+-"))
            python = {d: found for d, found in python.items() if d < depth}
            above = python[max(python)] if python else False
            if "Exchange" in line:
                above = False
            elif "ArrowEvalPython" in line or "MapInArrow" in line:
                assert not above, (name, line)
                above = True
            python[depth] = above
