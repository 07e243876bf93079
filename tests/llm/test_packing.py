import itertools
import zlib
from collections import defaultdict

import numpy as np
import pytest
from samples import as_docs
from tokenizers import Tokenizer

from residua.llm import packing as p
from residua.llm.vocabulary import DEFAULT_PATH


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(DEFAULT_PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def check(docs, library):
    rows = docs.select("doc_id", "text").collect()
    want = defaultdict(int)
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), 2048):
            piece = np.array(ids[at : at + 2048], "<u4")
            want[i, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    got = p.pack(docs).collect()
    found = defaultdict(int)
    sequences = defaultdict(list)
    for r in got:
        found[tuple(r)[:5]] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert found == want
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    return sum(r["length"] for r in got), len(sequences)


def test_documents(documents, library):
    tokens, sequences = check(documents, library)
    assert sequences <= -(-tokens // 2048) + 2


def test_edges(edges, no_docs, library):
    check(edges, library)
    assert p.pack(no_docs).collect() == []


def test_many_equal_lengths(spark, library):
    check(as_docs(spark, [(i % 3, "a b c d e f g h " * (20 * (i % 2) + 5)) for i in range(700)]).repartition(9), library)


@pytest.mark.parametrize("seed", range(30))
def test_fill_is_optimal(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(41, np.int64)
    for n in rng.integers(1, 41, 7):
        counts[n] += 1
    use = np.array(p.fill(counts, 40))
    assert (use <= counts).all()
    lengths = np.repeat(np.arange(41), counts).tolist()
    longest = max(lengths)
    rest = sorted(lengths)
    rest.remove(longest)
    best = max(
        longest + sum(c) for k in range(len(rest) + 1) for c in itertools.combinations(rest, k) if longest + sum(c) <= 40
    )
    assert use @ np.arange(41) == best


def test_special_strings_and_long_runs(library):
    ids = p.ids_of()
    for text in ["<|endoftext|> x", " " * 300_000, "ab" * 50_000, "中" * 1000]:
        assert list(ids(text)) == library.encode(text, add_special_tokens=False).ids
