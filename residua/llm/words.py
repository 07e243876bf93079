"""Texts of an Arrow batch as bytes, and their words as spans and 64-bit hashes.

A word is ``[^\\x20\\x09-\\x0D]+``. The separators are ASCII, so words are found in UTF-8
bytes without decoding. Everything is computed per block of documents, so that the memory
a task needs depends on the block and on the longest single text, not on the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
WORD_BYTE = np.ones(256, dtype=bool)
WORD_BYTE[[9, 10, 11, 12, 13, 32]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Odd multipliers of the polynomial hashes.
BYTE_BASE = U64(0x9E3779B97F4A7C15)
WORD_BASE = U64(0xD1B54A32D192ED03)

BLOCK_BYTES = 2 << 20
_WORDS_AT_ONCE = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS = powers(BYTE_BASE, 1024)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, a function of its bytes alone."""
    out = np.empty(len(starts), U64)
    for at in range(0, len(starts), _WORDS_AT_ONCE):
        s, n = starts[at : at + _WORDS_AT_ONCE], (ends - starts)[at : at + _WORDS_AT_ONCE]
        first = np.cumsum(n) - n
        within = np.arange(int(n.sum())) - np.repeat(first, n)
        longest = int(n.max())
        power = _POWERS if longest <= len(_POWERS) else powers(BYTE_BASE, longest)
        terms = (data[within + np.repeat(s, n)].astype(U64) + U64(1)) * power[within]
        out[at : at + _WORDS_AT_ONCE] = mix(np.add.reduceat(terms, first) ^ (n.astype(U64) << U64(48)))
    return out


def hash_windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive values, by doubling."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    done, length, block, width, factor = None, 0, words, 1, WORD_BASE
    with np.errstate(over="ignore"):
        while True:
            if size & width:
                # The block goes behind what is done.
                part = block[length : length + n]
                done = part.copy() if done is None else done[:n] * factor + part
                length += width
            if length == size:
                return mix(done[:n])
            block = block[:-width] * factor + block[width:]
            width, factor = 2 * width, factor * factor


@dataclass
class Words:
    """The words of some consecutive texts of a batch."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    @property
    def n_docs(self) -> int:
        return len(self.offsets) - 1

    @cached_property
    def is_word(self) -> np.ndarray:
        return WORD_BYTE[self.data]

    def _edges(self) -> tuple[np.ndarray, np.ndarray]:
        inside = np.empty(len(self.data) + 1, bool)
        inside[0] = False
        inside[1:] = self.is_word
        before, after = inside[:-1].copy(), np.append(inside[2:], False)
        full = np.flatnonzero(np.diff(self.offsets))
        before[self.offsets[full]] = False
        after[self.offsets[full + 1] - 1] = False
        return np.flatnonzero(self.is_word & ~before), np.flatnonzero(self.is_word & ~after) + 1

    @cached_property
    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return self._edges()

    @cached_property
    def ptr(self) -> np.ndarray:
        """Words of text ``i`` are ``ptr[i]`` to ``ptr[i + 1]``."""
        return np.searchsorted(self.spans[0], self.offsets)

    @cached_property
    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    @cached_property
    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.counts)

    @cached_property
    def hashes(self) -> np.ndarray:
        return hash_words(self.data, *self.spans)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all windows that lie in one text."""
        hashes = hash_windows(self.hashes, size)
        at = np.flatnonzero(np.arange(len(hashes)) + size <= np.repeat(self.ptr[1:], self.counts)[: len(hashes)])
        return at, hashes[at]

    def per_doc(self, values: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Sums of ``values`` between consecutive ``edges``."""
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[edges[1:]] - total[edges[:-1]]

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def blocks(column, lower: bool = False) -> Iterator[Words]:
    """The texts of a column in order, in blocks of some ``BLOCK_BYTES`` bytes.

    ``lower`` turns A-Z into a-z. A text is never cut.
    """
    data, offsets = text_bytes(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + BLOCK_BYTES, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        part = data[offsets[lo] : offsets[hi]]
        yield Words(LOWER[part] if lower else part, offsets[lo : hi + 1] - offsets[lo], lo)
        lo = hi


def repeated(keys: np.ndarray) -> np.ndarray:
    """Flags the values that occur more than once."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    flags = np.zeros(len(keys), bool)
    flags[order[1:]] |= same
    flags[order[:-1]] |= same
    return flags


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Flags the positions below ``n`` that lie in a window that begins at ``starts``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + size, n), -1)
    return np.cumsum(steps[:-1]) > 0
