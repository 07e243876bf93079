import math
import zlib
from collections import Counter

import pytest
from samples import as_docs

from residua.llm import language as l


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = l.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert [r["held_out"] for r in rows] == [zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows]
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.98


def test_edges(edges, no_docs):
    rows = l.identify(edges).collect()
    assert len(rows) == edges.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (4, 5, 6, 19))
    assert by[1]["lang_pred"] == "en"
    assert l.identify(no_docs).collect() == []


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id bigint, text string, lang string")
    assert [r["lang_pred"] for r in l.identify(docs).collect()] == ["und"]


def test_too_many_languages(documents):
    with pytest.raises(Exception, match="max_languages"):
        l.train(documents, l.Settings(max_languages=1))


def plain_grams(text, n_max=4):
    """n-grams of the text with runs of other characters as blanks, as the module defines them."""
    out, runs = Counter(), ""
    for c in "".join(c.lower() if c.isascii() else c for c in text):
        if c.isalpha():
            runs += c
        elif runs and runs[-1] != " ":
            runs += " "
    for n in range(1, n_max + 1):
        for i in range(len(runs) - n + 1):
            gram = runs[i : i + n]
            if gram[0] != " " or gram[-1] != " ":
                out[gram] += 1
    return out


def test_prediction_against_plain_naive_bayes(spark, documents):
    rows = documents.collect()
    counts = {}
    for r in rows:
        if zlib.crc32(str(r["doc_id"]).encode()) % 5:
            counts.setdefault(r["lang"], Counter()).update(plain_grams(r["text"] or ""))
    buckets = 1 << l.Settings().bits
    totals = {k: sum(c.values()) + 0.5 * buckets for k, c in counts.items()}
    got = {r["doc_id"]: r["lang_pred"] for r in l.identify(documents).collect()}
    agree = 0
    for r in rows:
        grams = plain_grams(r["text"] or "")
        want = max(sorted(counts), key=lambda k: sum(n * math.log((counts[k][g] + 0.5) / totals[k]) for g, n in grams.items()))
        agree += got[r["doc_id"]] == (want if grams else "und")
    # Hashed buckets collide now and then.
    assert agree / len(rows) > 0.99


def test_order_and_partitions_do_not_matter(documents):
    one, many = (sorted(map(tuple, l.identify(documents.repartition(n)).select("doc_id", "lang_pred").collect())) for n in (1, 5))
    assert one == many


def test_long_texts_are_read_whole(spark, monkeypatch):
    text = "der die das und " * 200 + "the of and to " * 5000
    docs = as_docs(spark, [(1, "der die das und ist nicht " * 50), (2, "the of and to is not " * 50)])
    model = l.train(docs.withColumn("lang", docs.doc_id.cast("string")))
    pa = __import__("pyarrow")
    monkeypatch.setattr(l, "_CHARS_AT_ONCE", 1000)
    total, n = l._scores(pa.array([text, "é" * 3000]), model)
    assert total[0].argmax() == 1 and n[0] > 50_000


@pytest.mark.parametrize("at_once", [4, 5, 6, 7, 100])
@pytest.mark.parametrize("orders", [(1, 2, 3, 4), (1,), (3,)])
def test_parts_of_long_texts_count_as_the_whole(monkeypatch, at_once, orders):
    pa, np = __import__("pyarrow"), __import__("numpy")
    texts = ["The  end, é日本 12345678901 of it... " * 5, "!!!---???", "", "  a", "b  ", "x1y" * 40, "Ünïcödé" * 20, "...." * 30 + "z" + "----" * 30]
    settings = l.Settings(orders=orders)

    def counted():
        out = Counter()
        for points, doc, carried in l._parts(pa.array(texts), settings):
            bucket, owner = l.grams(points, doc, settings, carried)
            out.update(zip(owner.tolist(), bucket.tolist()))
        return out

    whole = counted()
    assert {i for i, _ in whole} <= {0, 3, 4, 5, 6, 7} and sum(whole.values()) > 200
    # Both the scores and the training are sums of these.
    model = l.Model(["a"], np.random.default_rng(1).random((1, 1 << settings.bits)), settings)
    total, n = l._scores(pa.array(texts), model)
    monkeypatch.setattr(l, "_CHARS_AT_ONCE", at_once)
    assert counted() == whole
    cut_total, cut_n = l._scores(pa.array(texts), model)
    assert cut_n.tolist() == n.tolist() and np.allclose(cut_total, total)
