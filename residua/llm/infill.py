"""Fill-in-middle transformation of texts by displacement scatter, and its inverse.

A text is cut at two ends of tokens into prefix, middle and suffix, which swap places behind
sentinels. The cuts of all texts of a block are found in one scan of its bytes. Every part is
moved by one shift, so an array of differences that is nonzero only where a part begins, summed
up along the block, gives each byte its shift; one scatter then builds all outputs of the block.
The inverse finds the sentinels in the outputs, gets the shifts in the same way, and gathers the
bytes back. Both walk the bytes in strips, so that beside the texts of a block and their
outputs the memory they need is fixed.

Defined results: a null text is an empty one; an empty text has no tokens and is plain, and so
is a text that holds a sentinel. A null id draws as the empty string does. Rows that repeat give
equal results, an empty table gives no rows. Other columns are kept unless they bear the name of
a new column; those are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .tasks import map_arrow
from .words import Words, blocks


@dataclass(frozen=True)
class Settings:
    seed: int = 42
    # Shares in a hundred: texts that are transformed, and those of them in suffix-first order.
    transformed: int = 50
    suffix_first: int = 80
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"], dtype=object)
# Bytes that are moved at a time.
_STRIP = 1 << 18

NEW = StructType([
    StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()),
    StructField("middle_chars", LongType()), StructField("output", StringType()),
])


def draws(doc_id, seed: int) -> list:
    """Columns ``h1`` to ``h4``: four 32-bit numbers of a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]


def _token_ends(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Ends of all tokens of a block, and of which text ``i`` they are ``ptr[i]`` to ``ptr[i + 1]``.

    A token ends where a word ends; white space behind the last word is one token more.
    """
    last = np.concatenate([[0], w.spans[1]])[np.where(w.counts > 0, w.ptr[1:], 0)]
    end = w.offsets[1:]
    trailing = (end > w.offsets[:-1]) & (np.where(w.counts > 0, last, -1) < end)
    ends = np.concatenate([w.spans[1], end[trailing]])
    doc = np.concatenate([w.doc_of_word, np.flatnonzero(trailing)])
    # By text; a text's trailing token is its last.
    order = np.argsort(doc, kind="stable")
    return ends[order], np.searchsorted(doc[order], np.arange(w.n_docs + 1))


def _holders(w: Words, sentinels: list[bytes]) -> np.ndarray:
    """Flags the texts that hold a sentinel."""
    flags = np.zeros(w.n_docs, bool)
    for sentinel in sentinels:
        for at in _places(w.data, sentinel):
            doc = int(np.searchsorted(w.offsets, at, "right")) - 1
            flags[doc] |= at + len(sentinel) <= w.offsets[doc + 1]
    return flags


def _places(data: np.ndarray, word: bytes) -> list[int]:
    """Where ``word`` begins in the bytes."""
    out, raw, at = [], data.tobytes(), -1
    while (at := raw.find(word, at + 1)) >= 0:
        out.append(at)
    return out


def scatter(out: np.ndarray, data: np.ndarray, starts: np.ndarray, shifts: np.ndarray, back: bool = False) -> None:
    """Moves each byte ``i`` of ``data`` to ``i + shift``; ``shifts`` hold from the ``starts`` on.

    The starts ascend from 0 and may be equal, where the last one holds. ``back`` gathers
    instead: byte ``i`` of ``data`` is read from ``out[i + shift]``.
    """
    steps = np.diff(shifts, prepend=0)
    for lo in range(0, len(data), _STRIP):
        hi = min(lo + _STRIP, len(data))
        a, b = np.searchsorted(starts, [lo, hi])
        change = np.zeros(hi - lo, np.int64)
        change[0] = shifts[a - 1] if a else 0
        np.add.at(change, starts[a:b] - lo, steps[a:b])
        place = np.cumsum(change) + np.arange(lo, hi)
        if back:
            data[lo:hi] = out[place]
        else:
            out[place] = data[lo:hi]


def _layout(form: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, mark: list[int]) -> tuple:
    """Places in its output of each text's parts (prefix, middle, suffix), and the output's size.

    ``a`` and ``b`` are the sizes of the text up to the middle and up to the suffix.
    """
    p, s, m = mark
    prefix = np.select([form == PSM, form == SPM], [np.full(len(a), p), s + size - b + p], 0)
    suffix = np.select([form == PSM, form == SPM], [p + a + s, np.full(len(a), s)], b)
    middle = np.where(form == PLAIN, a, p + s + m + a + size - b)
    return prefix, middle, suffix, size + np.where(form == PLAIN, 0, p + s + m)


def _three(*columns: np.ndarray) -> np.ndarray:
    return np.stack(columns, axis=1).ravel()


def _columns(w: Words, draw: np.ndarray, settings: Settings) -> dict:
    """The new columns of the texts of a block."""
    sentinels = [x.encode() for x in (settings.prefix, settings.suffix, settings.middle)]
    mark = [len(x) for x in sentinels]
    size = np.diff(w.offsets)
    ends, ptr = _token_ends(w)
    n = np.diff(ptr)
    plain = (size == 0) | (draw[2] % 100 >= settings.transformed) | _holders(w, sentinels)
    form = np.where(plain, PLAIN, np.where(draw[3] % 100 < settings.suffix_first, SPM, PSM))

    def cut(units: np.ndarray) -> np.ndarray:
        behind = np.concatenate([ends, [0]])[np.where(units > 0, ptr[:-1] + units - 1, len(ends))]
        return np.where(units > 0, behind - w.offsets[:-1], 0)

    one, two = draw[0] % (n + 1), draw[1] % (n + 1)
    a, b = cut(np.minimum(one, two)), cut(np.maximum(one, two))
    prefix, middle, suffix, total = _layout(form, size, a, b, mark)
    base, first = w.offsets[:-1], np.concatenate([[0], np.cumsum(total)])
    out = np.zeros(int(first[-1]), np.uint8)
    starts = _three(base, base + a, base + b)
    scatter(out, w.data, starts, _three(first[:-1] + prefix, first[:-1] + middle, first[:-1] + suffix) - starts)
    moved = np.flatnonzero(form)
    for place, sentinel in zip((prefix, suffix, middle), sentinels):
        at = (first[:-1] + place)[moved] - len(sentinel)
        out[at[:, None] + np.arange(len(sentinel))] = np.frombuffer(sentinel, np.uint8)
    chars = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80, dtype=np.int64)])
    hidden = form == PLAIN
    return {
        "n": n, "form": pa.array(FORMS[form]),
        "prefix_chars": pa.array(chars[base + a] - chars[base], mask=hidden),
        "middle_chars": pa.array(chars[base + b] - chars[base + a], mask=hidden),
        "output": _strings(out, first),
    }


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    large = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))
    return large.cast(pa.string())


def _others(df: DataFrame, without: list[str]) -> tuple[list, list, list]:
    """Columns of ``df`` to carry along under plain names, and the way back; the rest is replaced."""
    fields = [f for f in df.schema.fields if f.name.lower() not in without]
    there = [F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(fields)]
    back = [F.col(f"c{i}").alias(f.name, metadata=f.metadata) for i, f in enumerate(fields)]
    return there, back, [StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)]


def _carried(batch: pa.RecordBatch, w: Words, fields: list) -> dict:
    return {f.name: batch.column(f.name).slice(w.first, w.n_docs) for f in fields}


def fill_in_middle(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``n, form, prefix_chars, middle_chars, output`` in place of ``text``; other columns stay.

    ``docs`` has ``doc_id, text``. ``n`` counts tokens ``[ws]*[other]+|[ws]+``; the sizes are in
    code points, null where plain.
    """
    there, back, fields = _others(docs, ["text", *NEW.names])
    text = F.col("text").cast("string").alias("text")
    rows = docs.select(*there, text, *draws(F.col("doc_id"), settings.seed))

    def each(batch):
        draw = np.stack([batch.column(f"h{i}").to_numpy() for i in range(1, 5)])
        for w in blocks(batch.column("text")):
            yield _carried(batch, w, fields) | _columns(w, draw[:, w.first : w.first + w.n_docs], settings)

    return map_arrow(rows, StructType(fields + NEW.fields), each).select(*back, *NEW.names)


def _restored(w: Words, form: np.ndarray, settings: Settings) -> pa.Array:
    """The texts from a block of outputs and their forms alone."""
    sentinels = [x.encode() for x in (settings.prefix, settings.suffix, settings.middle)]
    mark = [len(x) for x in sentinels]
    base, moved = w.offsets[:-1], np.flatnonzero(form)
    # A moved text holds each sentinel once; those of plain texts and across texts are passed over.
    found = np.zeros((3, w.n_docs), np.int64)
    for row, sentinel in enumerate(sentinels):
        at = np.array(_places(w.data, sentinel), np.int64)
        doc = np.searchsorted(w.offsets, at, "right") - 1
        inside = (form[doc] != PLAIN) & (at + len(sentinel) <= w.offsets[doc + 1])
        if np.any(np.diff(doc[inside]) == 0) or not np.array_equal(doc[inside], moved):
            raise ValueError(f"an output does not hold {sentinel.decode()} once")
        found[row, moved] = (at - base[doc])[inside]
    size = np.diff(w.offsets) - np.where(form == PLAIN, 0, sum(mark))
    p, s, m = found
    a = np.select([form == PSM, form == SPM], [s - mark[0], m - p - mark[0]], 0)
    after = np.select([form == PSM, form == SPM], [m - s - mark[1], p - mark[1]], size)
    prefix, middle, suffix, _ = _layout(form, size, a, size - after, mark)
    first = np.concatenate([[0], np.cumsum(size)])
    text = np.zeros(int(first[-1]), np.uint8)
    starts = _three(first[:-1], first[:-1] + a, first[:-1] + size - after)
    scatter(w.data, text, starts, _three(base + prefix, base + middle, base + suffix) - starts, back=True)
    return _strings(text, first)


def restore(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``restored``, the text before the transformation, in place of ``output``; the rest stays.

    ``rows`` has ``output, form``; nothing else is used but the settings' sentinels. A null
    output is empty, a null form is plain.
    """
    there, back, fields = _others(rows, ["output", "restored"])
    code = F.when(F.col("form") == "psm", PSM).when(F.col("form") == "spm", SPM).otherwise(PLAIN)
    coded = rows.select(*there, F.col("output"), code.cast("int").alias("code"))

    def each(batch):
        form = batch.column("code").to_numpy()
        for w in blocks(batch.column("output")):
            restored = _restored(w, form[w.first : w.first + w.n_docs], settings)
            yield _carried(batch, w, fields) | {"restored": restored}

    return map_arrow(coded, StructType([*fields, StructField("restored", StringType())]), each).select(*back, "restored")
