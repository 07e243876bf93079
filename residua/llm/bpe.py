"""Byte-level BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

A text is split into pieces; each piece is merged on its own. The leaves of a piece's tree
hold ``rank * width + place`` of the pair that begins at each symbol, inner nodes the least
of their children, so the root is the leftmost pair of the lowest rank. A merge changes three
leaves and the nodes above them. Pieces of similar length go through the steps together, as
rows of one array. Pieces that have been seen are kept in a bounded table.

Defined results: a null text counts as empty and has no tokens. Strings of special tokens in
a text become those tokens, as the tokenizers library does by default. Every row is encoded
by itself; repeated rows give equal rows, an empty table none. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers.pre_tokenizers import ByteLevel

from .tasks import columns_as, map_arrow
from .vocabulary import DEFAULT_PATH, SPLIT_PATTERN, vocabulary
from .words import text_bytes

NO_PAIR = np.int64(1) << 62
# Pieces kept per worker; beyond that the table starts anew.
KEPT_PIECES = 500_000
# Rows of one array in a merge run, by cells.
_CELLS = 1 << 21
# Below this byte all characters are older than any Unicode version in use, so that both
# engines agree on their classes. Texts with others are split by the tokenizers library.
_NEW_SCRIPTS = 0xD4
# Texts are worked on in runs of this many pieces.
_PIECES_AT_ONCE = 200_000
# Bytes of texts that are merged together.
_TEXTS_AT_ONCE = 4 << 20


class Merger:
    def __init__(self, path: str) -> None:
        self.words = vocabulary(path)
        merges = np.array(self.words.merges, np.int64).reshape(-1, 3)
        keys = merges[:, 0] << 32 | merges[:, 1]
        # Of a pair that stands twice in the file the last rank holds.
        keys, last = np.unique(keys[::-1], return_index=True)
        self.keys, self.rank = keys, len(merges) - 1 - last
        self.merged = merges[:, 2]
        self.byte_ids = np.array(self.words.byte_ids, np.int64)
        self.kept: dict[str, bytes] = {}

    def pair_keys(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
        """Leaf values of pairs."""
        if not len(self.keys):
            return np.full(left.shape, NO_PAIR)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at] * width + place, NO_PAIR)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        lengths = np.array([len(p) for p in pieces])
        width = 1 << np.ceil(np.log2(np.maximum(lengths, 2))).astype(int)
        for size in np.unique(width[lengths > 0]):
            rows = np.flatnonzero((width == size) & (lengths > 0))
            step = max(1, _CELLS // int(size))
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                for row, ids in zip(some, self._merge_rows([pieces[i] for i in some], lengths[some], int(size))):
                    out[row] = ids
        return out

    def _merge_rows(self, pieces: list[bytes], n: np.ndarray, width: int) -> Iterator[bytes]:
        count = len(pieces)
        ids = np.full((count, width + 1), -1, np.int64)
        inside = np.arange(width) < n[:, None]
        ids[:, :width][inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        follow = np.tile(np.arange(1, width + 2), (count, 1))
        before = follow - 2
        tree = np.full((count, 2 * width), NO_PAIR)
        place = np.tile(np.arange(width), (count, 1))
        tree[:, width:] = np.where(
            place < n[:, None] - 1, self.pair_keys(ids[:, :-1], ids[:, 1:], place, width), NO_PAIR
        )
        node = width // 2
        while node:
            tree[:, node : 2 * node] = np.minimum(tree[:, 2 * node : 4 * node : 2], tree[:, 2 * node + 1 : 4 * node : 2])
            node //= 2
        alive = ids >= 0

        def put(rows: np.ndarray, leaves: np.ndarray, values: np.ndarray) -> None:
            at = leaves + width
            tree[rows, at] = values
            while width > 1 and at[0] > 1:
                at = at >> 1
                tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])

        rows = np.flatnonzero(tree[:, 1] < NO_PAIR)
        while len(rows):
            root = tree[rows, 1]
            at, merged = root % width, self.merged[root // width]
            right = follow[rows, at]
            beyond = follow[rows, right]
            ids[rows, at] = merged
            alive[rows, right] = False
            follow[rows, at] = beyond
            inner = beyond < n[rows]
            before[rows[inner], beyond[inner]] = at[inner]
            put(rows, right, np.full(len(rows), NO_PAIR))
            new = np.full(len(rows), NO_PAIR)
            new[inner] = self.pair_keys(merged[inner], ids[rows[inner], beyond[inner]], at[inner], width)
            put(rows, at, new)
            left = before[rows, at]
            has_left = left >= 0
            if has_left.any():
                r, p = rows[has_left], left[has_left]
                put(r, p, self.pair_keys(ids[r, p], merged[has_left], p, width))
            rows = rows[tree[rows, 1] < NO_PAIR]
        flat = ids[alive].astype("<u4").tobytes()
        ends = np.cumsum(alive.sum(axis=1)) * 4
        for lo, hi in zip(chain([0], ends), ends):
            yield flat[lo:hi]

    def look_up(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """A table that holds at least these pieces."""
        fresh = [p for p in set(pieces) if p not in self.kept]
        if fresh:
            if len(self.kept) + len(fresh) > KEPT_PIECES:
                self.kept = {}
                fresh = list(set(pieces))
            self.kept.update(zip(fresh, self.merge([p.encode() for p in fresh])))
        return self.kept

    @lru_cache
    def _split(self):
        return regex.compile(SPLIT_PATTERN), ByteLevel(add_prefix_space=False, use_regex=True)

    def pieces(self, text: str, raw: bytes) -> Iterator[list[str]]:
        """The pieces of a text in order, in runs of bounded length."""
        own, library = self._split()
        if raw and max(raw) >= _NEW_SCRIPTS:
            yield [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]
        elif len(raw) < 1 << 20:
            yield own.findall(text)
        else:
            found = (m[0] for m in own.finditer(text))
            while run := list(islice(found, _PIECES_AT_ONCE)):
                yield run

    @lru_cache
    def _special(self):
        return regex.compile("|".join(regex.escape(s) for s in sorted(self.words.special, key=len, reverse=True)) or r"(?!)")

    def parts(self, raw: bytes) -> Iterator[list[str] | bytes]:
        """Runs of pieces, and ids of special tokens, of a text in order."""
        text, at = raw.decode(), 0
        marks = [(m.start(), m.end(), self.words.special[m[0]]) for m in self._special().finditer(text)]
        if not marks:
            yield from self.pieces(text, raw)
            return
        for start, end, token in marks:
            yield from self.pieces(text[at:start], text[at:start].encode())
            yield token.to_bytes(4, "little")
            at = end
        yield from self.pieces(text[at:], text[at:].encode())

    def _join(self, part: list[str] | bytes, table: dict[str, bytes]) -> bytes:
        return part if isinstance(part, bytes) else b"".join(map(table.__getitem__, part))

    def encode(self, raw: bytes) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        return b"".join(self._join(part, self.look_up(part) if isinstance(part, list) else {}) for part in self.parts(raw))

    def encode_all(self, raws: Iterable[bytes]) -> Iterator[bytes]:
        """Ids of each text; short texts are merged together, long ones alone."""
        waiting: list[list[list[str] | bytes]] = []
        size = 0
        for raw in raws:
            if len(raw) > _TEXTS_AT_ONCE:
                yield from self._encode_waiting(waiting)
                waiting, size = [], 0
                yield self.encode(raw)
                continue
            waiting.append(list(self.parts(raw)))
            size += len(raw)
            if size > _TEXTS_AT_ONCE:
                yield from self._encode_waiting(waiting)
                waiting, size = [], 0
        yield from self._encode_waiting(waiting)

    def _encode_waiting(self, waiting: list[list[list[str] | bytes]]) -> Iterator[bytes]:
        distinct: set[str] = set()
        for parts in waiting:
            for part in parts:
                if isinstance(part, list):
                    distinct.update(part)
        table = self.look_up(distinct)
        for parts in waiting:
            yield b"".join(self._join(part, table) for part in parts)

    def decode(self, ids: bytes) -> bytes:
        """Text of the ids in UTF-8; what is no UTF-8 becomes U+FFFD."""
        raw = b"".join(map(self.words.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace").encode()


@lru_cache(maxsize=2)
def merger(path: str = DEFAULT_PATH) -> Merger:
    return Merger(path)


def _raw_texts(batch) -> Iterator[bytes]:
    data, offsets = text_bytes(batch.column("text"))
    for i in range(len(offsets) - 1):
        yield data[offsets[i] : offsets[i + 1]].tobytes()


def encode(docs: DataFrame, path: str = DEFAULT_PATH) -> DataFrame:
    """``doc_id, ids``: the ids of every whole text as an array."""

    def each(batch):
        for i, ids in enumerate(merger(path).encode_all(_raw_texts(batch))):
            yield {"doc_id": batch.column("doc_id").slice(i, 1), "ids": [np.frombuffer(ids, "<i4")]}

    texts = columns_as(docs, doc_id=("doc_id", "bigint"), text=("text", "string"))
    return map_arrow(texts, "doc_id bigint, ids array<int>", each)


def decode(tokens: DataFrame, path: str = DEFAULT_PATH) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give a null text."""

    def each(batch):
        ids = batch.column("ids").to_pylist()
        texts = [None if x is None else merger(path).decode(np.array(x, "<u4").tobytes()).decode() for x in ids]
        yield {"doc_id": batch.column("doc_id"), "text": texts}

    return map_arrow(columns_as(tokens, doc_id=("doc_id", "bigint"), ids=("ids", "array<int>")), "doc_id bigint, text string", each)


def round_trip(docs: DataFrame, path: str = DEFAULT_PATH) -> DataFrame:
    """Encodes and decodes every text; returns the number of tokens and digests of both."""

    def each(batch):
        own = merger(path)
        n, ids_sha, text_sha = [], [], []
        for ids in own.encode_all(_raw_texts(batch)):
            n.append(len(ids) // 4)
            ids_sha.append(hashlib.sha256(ids).hexdigest())
            text_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
        yield {"doc_id": batch.column("doc_id"), "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": text_sha}

    texts = columns_as(docs, doc_id=("doc_id", "bigint"), text=("text", "string"))
    return map_arrow(texts, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string", each)
