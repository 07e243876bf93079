import hashlib
import re

import numpy as np
import pytest
from oracle import compare, connect
from samples import SF, as_docs, bag

from residua.llm import infill
from residua.llm.queries import QUERIES, SQL

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def by_hand(doc_id, text, s=infill.Settings()):
    text = text or ""
    tokens = TOKEN.findall(text)
    assert "".join(tokens) == text
    digest = hashlib.sha256(f"{s.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    one, two = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (tokens[:one], tokens[one:two], tokens[two:]))
    if not text or any(m in text for m in (s.prefix, s.suffix, s.middle)) or h3 % 100 >= s.transformed:
        return (doc_id, len(tokens), "plain", None, None, text)
    if h4 % 100 < s.suffix_first:
        out, form = s.suffix + suffix + s.prefix + prefix + s.middle + middle, "spm"
    else:
        out, form = s.prefix + prefix + s.suffix + suffix + s.middle + middle, "psm"
    return (doc_id, len(tokens), form, len(prefix), len(middle), out)


EXTRA = [
    (100 + i, t) for i, t in enumerate([
        "a <P> b", "x<S>", "<M>", "< P>", "<P", "P> <P", "  lead", "trail  ", "é ü\t中文\n", "\U0001f600 x \U0001f600", " ", "\x1c a\x85b c",
        "<<P> >", "one", "S> <M a", ">", "<",
    ])
] + [(1000 + i, f"w{i} <" * (i % 7) + " >S> " * (i % 3)) for i in range(200)]


@pytest.fixture(scope="module")
def rows(spark, edges):
    return edges.unionByName(as_docs(spark, EXTRA))


@pytest.mark.parametrize("settings", [
    infill.Settings(), infill.Settings(transformed=100), infill.Settings(transformed=100, suffix_first=0),
    infill.Settings(seed=7, transformed=100, prefix="<pre>", suffix="<suf>", middle="<mid>"),
])
def test_against_plain_version(rows, settings):
    made = infill.fill_in_middle(rows, settings)
    want = [by_hand(r.doc_id, r.text, settings) for r in rows.select("doc_id", "text").collect()]
    assert bag(made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")) == sorted(want, key=repr)
    back = infill.restore(made, settings).select("doc_id", "restored")
    assert bag(back) == sorted(((r.doc_id, r.text or "") for r in rows.select("doc_id", "text").collect()), key=repr)


def test_strips_do_not_matter(rows, monkeypatch):
    want = bag(infill.fill_in_middle(rows.select("doc_id", "text")))
    w = next(infill.blocks(rows.select("text").toArrow().column("text")))
    draw = np.random.default_rng(1).integers(0, 1 << 32, (4, w.n_docs))
    whole = infill._columns(w, draw, infill.Settings(transformed=100))["output"].to_pylist()
    monkeypatch.setattr(infill, "_STRIP", 5)
    assert infill._columns(w, draw, infill.Settings(transformed=100))["output"].to_pylist() == whole
    assert want == bag(infill.fill_in_middle(rows.repartition(5).select("doc_id", "text")))


def test_columns_stay_and_clashing_names_are_replaced(rows):
    named = rows.withColumn("Form", rows.k).withColumn("h1", rows.k).withColumn("c0", rows.tag)
    made = infill.fill_in_middle(named)
    assert [c.lower() for c in made.columns].count("form") == 1
    assert made.columns[-5:] == infill.NEW.names and "text" not in made.columns
    row = made.where("doc_id = 3").first()
    assert (row.h1, row.c0, row.k, row.usable) == ("k", "t", "k", "u")
    assert infill.restore(made).columns == [c for c in made.columns if c != "output"] + ["restored"]


def test_damaged_outputs_are_refused(spark):
    bad = spark.createDataFrame([("psm", "<P>a<S>b"), ], "form string, output string")
    with pytest.raises(Exception, match="does not hold"):
        infill.restore(bad).collect()
    plain = spark.createDataFrame([(None, "<P>a<S>b"), ("plain", None)], "form string, output string")
    assert bag(infill.restore(plain).select("restored")) == [("",), ("<P>a<S>b",)]


def test_empty_table(no_docs):
    assert infill.restore(infill.fill_in_middle(no_docs)).collect() == []


def test_long_text(spark):
    text = ("word " * 400_000) + "\n" * 1000
    row = infill.restore(infill.fill_in_middle(as_docs(spark, [(1, text)]), infill.Settings(transformed=100))).first()
    assert row.restored == text and row.n == 400_001 and row.form != "plain"


def test_query_matches_sql(spark):
    name = "op12_displacement_infill"
    assert compare(QUERIES[name](spark, SF), connect(SF), SQL[name]) is None
