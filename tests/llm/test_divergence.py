import math
from collections import Counter

import numpy as np
import pytest
from samples import WORDS, as_docs, prose

from residua.llm import divergence as d


def base(text):
    words = WORDS.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + j for i, w in enumerate(windows) if w in often for j in range(5)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered), len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def check_base(docs):
    rows = {(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()}
    want = sorted(((i, *base(t)) for i, t in rows), key=repr)
    got = d.divergence_rules(docs)
    assert got.count() == docs.count()
    assert sorted({tuple(r) for r in got.select("doc_id", *COLUMNS).collect()}, key=repr) == sorted(set(want), key=repr)


def test_base_counts(documents):
    check_base(documents)


def test_edges(edges, no_docs):
    check_base(edges)
    assert d.divergence_rules(no_docs).collect() == []


def by_hand(docs, rules=d.Rules()):
    """The verdicts in plain Python."""
    classes = [set("abcdefghijklmnopqrstuvwxyz"), set("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), set("0123456789"), set(" \t\n\r\x0b\x0c"), set(".,;:?'\"()-")]

    def chars(text):
        out = [0] * 7
        for c in text:
            out[next((i for i, s in enumerate(classes) if c in s), 5 if ord(c) < 128 else 6)] += 1
        return out

    def short(word):
        return len(word) <= 6 and all(c.isascii() and c.isalpha() or ord(c) > 127 for c in word)

    def distance(p, q):
        a, b = sum(p) or 1, sum(q) or 1
        total = 0
        for x, y in zip(p, q):
            x, y = x / a, y / b
            total += sum(v * math.log2(v / ((x + y) / 2)) for v in (x, y) if v)
        return math.sqrt(max(total / 2, 0))

    rows = [(r["doc_id"], r["text"] or "", r["lang"]) for r in docs.collect()]
    shares, refs = {}, {}
    for _, text, lang in rows:
        _, w = refs.setdefault(lang, ([0] * 7, Counter()))
        w.update(WORDS.findall(text))
        if text:
            shares.setdefault(lang, []).append([4096 * n // len(text) for n in chars(text)])
    for lang, of_texts in shares.items():
        refs[lang][0][:] = [sorted(column)[(len(column) - 1) // 2] for column in zip(*of_texts)]
    verdicts = {}
    for i, text, lang in rows:
        c, w = refs[lang]
        common = [x for x, _ in sorted(((x, n) for x, n in w.items() if short(x)), key=lambda x: (-x[1], x[0].encode()))][: rules.n_common]
        own = Counter(WORDS.findall(text))
        histogram = lambda counts: [counts[x] for x in common] + [sum(counts.values()) - sum(counts[x] for x in common)]
        far = sum(w.values()) >= rules.min_reference_words and (
            (len(text) >= rules.min_chars and distance(chars(text), c) > rules.max_char_distance)
            or (sum(own.values()) >= rules.min_words and distance(histogram(own), histogram(w)) > rules.max_word_distance)
        )
        verdicts[i] = not base(text)[-1] and not far
    return verdicts


def test_verdict_against_plain_python(documents):
    got = {r["doc_id"]: r["kept"] for r in d.divergence_rules(documents).collect()}
    assert got == by_hand(documents)
    assert 0 < sum(got.values()) < len(got)


def test_junk_goes_and_prose_stays(spark):
    common = ["the", "of", "and", "to", "in"]
    text = lambda s: " ".join(w if i % 3 else common[(i + s) % 5] for i, w in enumerate(prose(s, 200, 9000).replace("w1", "ab").split()))
    good = [(i, text(i)) for i in range(40)]
    junk = [(100, text(100).upper()), (101, " | ".join(prose(50, 200, 9000).split())), (102, "#$% ".join(text(102).split()))]
    kept = {r["doc_id"]: r["kept"] for r in d.divergence_rules(as_docs(spark, good + junk)).collect()}
    assert all(kept[i] for i, _ in good)
    assert not any(kept[i] for i, _ in junk)


def test_partitions_do_not_matter(documents):
    one, many = (sorted(map(tuple, d.divergence_rules(documents.repartition(n)).collect())) for n in (1, 7))
    assert one == many


def test_too_many_languages(documents):
    with pytest.raises(ValueError, match="languages"):
        d.divergence_rules(documents, d.Rules(max_languages=1))


def test_distance_bounds():
    assert d.js_distance(np.array([[1, 0]]), np.array([[0, 5]])) == pytest.approx(1)
    assert d.js_distance(np.array([[2, 2]]), np.array([[5, 5]])) == pytest.approx(0)


def symbols_and_prose(spark):
    """A third of all rows are full of symbols."""
    common = ["the", "of", "and", "to", "in"]
    text = lambda s: " ".join(w if i % 3 else common[(i + s) % 5] for i, w in enumerate(prose(s, 200, 9000).replace("w1", "ab").split()))
    good = [(i, text(i)) for i in range(60)]
    return good, [(100 + i, "#$% <|> ".join(text(100 + i).split())) for i in range(30)]


def test_symbols_count_and_reject_no_prose(spark):
    good, symbols = symbols_and_prose(spark)
    docs = as_docs(spark, good + symbols)
    kept = {r["doc_id"]: r["kept"] for r in d.divergence_rules(docs).collect()}
    assert all(kept[i] for i, _ in good) and not any(kept[i] for i, _ in symbols)
    words = sum(r["n"] for r in d.reference_counts(docs).where("kind = 'words'").collect())
    assert words == sum(len(WORDS.findall(t)) for _, t in good + symbols)


def test_language_with_symbols_only_is_judged(spark):
    _, symbols = symbols_and_prose(spark)
    odd = (500, "A B C D E F G H I J " * 3 + " ".join(prose(9, 150, 9000).upper().split()))
    kept = {r["doc_id"]: r["kept"] for r in d.divergence_rules(as_docs(spark, [*symbols, odd])).collect()}
    assert all(kept[i] for i, _ in symbols) and not kept[500]


def test_language_without_references(spark):
    docs = as_docs(spark, [(1, prose(1, 300, 9000)), (2, "few words")])
    for refs in (d.References(), d.references(docs.selectExpr("doc_id", "upper(text) AS text", "'other' AS lang"))):
        got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in d.judge(docs, refs).collect()}
        assert got == {1: (False, True), 2: (True, False)}
