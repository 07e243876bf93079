import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from residua.llm import bpe

OWN = bpe.merger()


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(bpe.DEFAULT_PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


LIBRARY = Tokenizer.from_file(bpe.DEFAULT_PATH)


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def check(docs, library):
    want = []
    for i, text in docs.select("doc_id", "text").collect():
        found = library.encode(text or "", add_special_tokens=False).ids
        packed = np.array(found, "<u4").tobytes()
        want.append((i, len(found), hashlib.sha256(packed).hexdigest(),
                     hashlib.sha256(library.decode(found, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, bpe.round_trip(docs).collect()), key=repr) == sorted(want, key=repr)


def test_documents(documents, library):
    check(documents, library)


def test_edges(edges, no_docs, library):
    check(edges, library)
    assert bpe.round_trip(no_docs).collect() == []
    back = bpe.decode(bpe.encode(edges)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in back) == sorted((r["doc_id"] or 0, r["text"] or "") for r in edges.collect())


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    found = OWN.encode(text.encode())
    assert ids(found) == LIBRARY.encode(text, add_special_tokens=False).ids
    assert OWN.decode(found).decode() == text


def test_long_and_odd_texts(library):
    rng = random.Random(3)
    texts = ["a" * 5000, " " * 3000, "ab" * 4000 + "\n" * 70, "<|endoftext|><|endoftext|> a", "x " * 700_000,
             "".join(chr(rng.choice([32, 65, 0xE9, 0x558, 0x4E2D, 0x1F600, 0x10940, 10])) for _ in range(5000))]
    for text, found in zip(texts, OWN.encode_all(t.encode() for t in texts)):
        assert ids(found) == library.encode(text, add_special_tokens=False).ids


def test_table_starts_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 3)
    own = bpe.Merger(bpe.DEFAULT_PATH)
    for text in ("one two three four five six", "seven eight one", ""):
        assert ids(own.encode(text.encode())) == library.encode(text, add_special_tokens=False).ids


def test_bytes_that_are_no_utf8(library):
    broken = [i for i, b in enumerate(OWN.words.token_bytes) if b == b"\xc3"]
    assert OWN.decode(np.array(broken, "<u4").tobytes()).decode() == library.decode(broken)
