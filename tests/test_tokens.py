import random

import pytest
from pyspark.sql import functions as F

from residua.functions import tokens
from residua.functions.vocabulary import ESM2, Vocabulary
from residua.operators.tokenize import token_counts, tokenize, tokenize_with
from residua.queries.tokens import letter_encoder

# Literal records with known tokens: the leading and trailing ids, and the length.
SHORT = "MNAKYDTDQGVGRMLFLGTIGLAVVVGGLMAYGYYYDGKTPSSGTSFHTASPSFSSRYRY"
LENGTHS = [256, 320, 458, 156, 438, 60, 217, 204, 352, 128, 447, 347, 948, 85, 137]


def by_hand(text, n, vocab=ESM2):
    """Character by character, the slow and obvious way."""
    ids, i, in_unknown = [], 0, False
    text = text or ""
    while i < len(text):
        literal = next((s for s in vocab.literals if text.startswith(s, i)), None)
        if literal:
            ids.append(vocab.ids[literal])
            i, in_unknown = i + len(literal), False
        elif text[i] in vocab.letters:
            ids.append(vocab.ids[text[i]])
            i, in_unknown = i + 1, False
        elif text[i].isspace():
            i, in_unknown = i + 1, False
        else:
            if not in_unknown:
                ids.append(vocab.unk_id)
            i, in_unknown = i + 1, True
    framed = [vocab.cls_id, *ids[: n - 2], vocab.eos_id]
    pads = n - len(framed)
    return framed + [vocab.pad_id] * pads, [1] * len(framed) + [0] * pads


def rows_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, sequence string")


def check(spark, texts, n, vocab=ESM2):
    rows = tokenize(rows_of(spark, texts), n, vocab).orderBy("i").collect()
    for row, text in zip(rows, texts):
        assert (row.input_ids, row.attention_mask) == by_hand(text, n, vocab), repr(text)[:200]


def test_vocabulary():
    assert len(ESM2.symbols) == 33
    assert (ESM2.cls_id, ESM2.pad_id, ESM2.eos_id, ESM2.unk_id, ESM2.mask_id) == (0, 1, 2, 3, 32)
    assert ESM2.ids["L"] == 4 and ESM2.ids["-"] == 30


def test_known_record(spark):
    row = tokenize(rows_of(spark, [SHORT, "MAFSAEDV" * 40]), 142).orderBy("i").collect()
    assert row[0].input_ids[:5] == [0, 20, 17, 5, 15] and row[0].input_ids[61:63] == [2, 1]
    assert sum(row[0].attention_mask) == 62
    assert row[1].input_ids[:9] == [0, 20, 5, 18, 8, 5, 9, 13, 7]
    assert row[1].input_ids[-1] == 2 and sum(row[1].attention_mask) == 142


def test_real_tokens_of_fifteen_lengths(spark):
    counted = token_counts(tokenize(rows_of(spark, ["A" * n for n in LENGTHS]), 142))
    assert counted.agg(F.sum("real_tokens")).first()[0] == 1980


@pytest.mark.parametrize("n", [2, 3, 14, 142])
def test_edge_texts(spark, n):
    check(spark, [
        "", None, " ", "\n", "A", "ACG\n", "jj", "JJJ", "A J J", "abLxy<mask>a<b", "<<<<", "<mask",
        "<mask><cls>L", "A b c\x1cd\x85e", "é" * 50, "\U0001f600L", "L" * 141 + "j",
        "L" * 140, "L" * 139 + "jjj" + "A", " " * 300 + "A", "a" * 300 + "A", ".-.-", "$\\[]^",
    ], n)


def test_random_texts(spark):
    rng = random.Random(5)
    pieces = [*"LAGVJjx <>\n\t-.é ", "<mask>", "<pad>", "<nope>", "<cls", "JJ", "KRM", "  "]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(0, 60))) for _ in range(600)]
    for n in (8, 40):
        check(spark, texts, n)


def test_long_texts_need_no_stack(spark):
    texts = ["<" * 200_000 + "A", "j " * 100_000, "x" * 300_000, "L" * 100_000 + "j", " " * 200_000]
    check(spark, texts, 142)
    check(spark, texts, 4098)


def test_all_symbols_of_a_text(spark):
    text = "ab<mask>L L<x"
    found = rows_of(spark, [text]).select(tokens.symbols(F.col("sequence"))).first()[0]
    assert found == ["ab", "<mask>", "L", "L", "<x"]


def test_ids_need_not_be_in_order(spark):
    vocab = Vocabulary(("C", "<cls>", "A", "<pad>", "<eos>", "G", "<unk>", "<mask>", "T"))
    check(spark, ["ACGT", "TTxxA<mask>", "", "NNN"], 6, vocab)


def test_length_must_hold_the_frame(spark):
    with pytest.raises(ValueError):
        tokenize(rows_of(spark, ["A"]), 1)


def test_plugged_in_tokeniser_agrees(spark):
    texts = [SHORT, "", "AJJA", None, "L" * 500]
    rows = tokenize_with(rows_of(spark, texts), letter_encoder(142)).orderBy("i").collect()
    native = tokenize(rows_of(spark, texts), 142).orderBy("i").collect()
    assert rows == native


def test_no_python_in_the_plan(spark, plan):
    assert "Python" not in plan(tokenize(rows_of(spark, [SHORT]), 142))
    assert "Python" in plan(tokenize_with(rows_of(spark, [SHORT]), lambda t: ([0], [1])))
