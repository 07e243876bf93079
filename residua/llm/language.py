"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased where they are ASCII, runs of other characters become one blank, and
the n-grams of one to four characters fall into a fixed number of buckets. Training adds up
the counts of all training texts per language in the tasks; the log-probability matrix, of
languages times buckets, goes to every task. A batch is scored as a sparse matrix: the
buckets of all its texts in a row, with the places where texts begin.

Defined results: a text that is null or has no letter gets ``und`` with score 0, as does
every text if nothing was learned. Ties go to the language that comes first in code point
order. Repeated rows are predicted alike. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tasks import columns_as, map_arrow, map_arrow_partition
from .words import U64, WORD_BASE, mix, text_bytes

UNDETERMINED = "und"
FOLDS = 5


@dataclass(frozen=True)
class Settings:
    """``max_languages`` times ``2 ** bits`` numbers of eight bytes are sent to every task."""

    bits: int = 15
    orders: tuple[int, ...] = (1, 2, 3, 4)
    smoothing: float = 0.5
    max_languages: int = 256


@dataclass
class Model:
    languages: list[str]
    log_probability: np.ndarray
    settings: Settings


_BLANK = ord(" ")
_CHARS_AT_ONCE = 1 << 20


def _letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x30000)], bool)


_IS_LETTER: list[np.ndarray] = []


def is_letter(points: np.ndarray) -> np.ndarray:
    if not _IS_LETTER:
        _IS_LETTER.append(_letter_table())
    table = _IS_LETTER[0]
    return table[np.minimum(points, len(table) - 1)] | ((points >= len(table)) & (points < 0x32000))


def _points(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)


def _cut(data: np.ndarray, lo: int, hi: int) -> int:
    """The start of a character at or before ``hi``, for texts worked on in parts."""
    while hi > lo and data[hi] & 0xC0 == 0x80:
        hi -= 1
    return hi


def _kept(points: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters, lower-cased where ASCII, and one blank a run of others; which are letters; the texts."""
    letter = is_letter(points)
    points = np.where((points >= 65) & (points <= 90), points + 32, points)
    points = np.where(letter, points, _BLANK).astype(U64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[1:] |= doc[1:] != doc[:-1]
    keep[:1] = True
    return points[keep], letter[keep], doc[keep]


def grams(points: np.ndarray, doc: np.ndarray, settings: Settings, carried: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, and the text of each; texts follow one another in ``doc``.

    Every text begins and ends with a blank, so no n-gram reaches into the next. N-grams that
    end in the first ``carried`` characters, which an earlier part had, are left to that part.
    """
    points, letter, doc = _kept(points, doc)
    shift = U64(64 - settings.bits)
    buckets, owners = [], []
    run = np.zeros(len(points), U64)
    for n in range(1, max(settings.orders) + 1):
        size = len(points) - n + 1
        if size <= 0:
            break
        run = run[:size] * WORD_BASE + points[n - 1 :]
        if n in settings.orders:
            whole = (doc[:size] == doc[n - 1 :]) & (letter[:size] | letter[n - 1 :])
            whole[: max(carried - n + 1, 0)] = False
            buckets.append((mix(run[whole] + U64(n)) >> shift).astype(np.int64))
            owners.append(doc[:size][whole])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(buckets), np.concatenate(owners)


def _parts(column, settings: Settings):
    """Code points of some texts at a time, and the text of each; long texts come in parts.

    Parts of one text meet between characters. A part begins with the last characters that were
    kept of those before it, for the n-grams across the cut; their number is the third value.
    """
    reach = max(*settings.orders, 2) - 1
    data, offsets = text_bytes(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + _CHARS_AT_ONCE, "right")) - 1
        if hi > lo:
            hi = min(hi, n)
            yield *_joined(data, offsets, lo, hi), 0
            lo = hi
            continue
        at, tail = int(offsets[lo]), np.zeros(0, np.uint32)
        while at < offsets[lo + 1]:
            last = int(offsets[lo + 1])
            end = last if at + _CHARS_AT_ONCE >= last else _cut(data, at, at + _CHARS_AT_ONCE)
            part = np.concatenate([tail, _points(data[at:end])])
            doc = np.full(len(part), lo, np.int64)
            yield part, doc, len(tail)
            tail = _kept(part, doc)[0][-reach:].astype(np.uint32)
            at = end
        lo += 1


def _joined(data, offsets, lo: int, hi: int):
    part = data[offsets[lo] : offsets[hi]]
    begins = (part & 0xC0) != 0x80
    doc = np.repeat(np.arange(lo, hi), np.diff(offsets[lo : hi + 1]))
    return _points(part), doc[begins]


def hold_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a row is held out; a null id is no reason to hold a row out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Learns from every row of ``text, lang`` whose language is not null."""
    buckets = 1 << settings.bits
    texts = columns_as(docs, text=("text", "string"), lang=("lang", "string")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )

    def counted(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            names = {name: k for k, name in enumerate(dict.fromkeys(langs))}
            if len(names) > settings.max_languages:
                raise ValueError(f"more than {settings.max_languages} languages; raise max_languages")
            index = np.array([names[x] for x in langs], np.int64)
            total = np.zeros(len(names) * buckets, np.int64)
            for points, doc, carried in _parts(batch.column("text"), settings):
                bucket, owner = grams(points, doc, settings, carried)
                total += np.bincount(index[owner] * buckets + bucket, minlength=len(total))
            for name, k in names.items():
                counts[name] = counts.get(name, 0) + total[k * buckets : (k + 1) * buckets]
        for name, row in counts.items():
            some = np.flatnonzero(row)
            yield {"lang": [name] * len(some), "bucket": some, "n": row[some]}

    sums = (
        map_arrow_partition(texts, "lang string, bucket int, n bigint", counted)
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )
    found = sums.limit(settings.max_languages * buckets + 1).toPandas()
    languages = sorted(found["lang"].unique())
    if len(languages) > settings.max_languages:
        raise ValueError(f"more than {settings.max_languages} languages; raise max_languages")
    counts = np.zeros((len(languages), buckets))
    counts[found["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(int), found["bucket"].to_numpy(int)] = found["n"]
    smooth = counts + settings.smoothing
    # All languages weigh the same: how often one occurs says nothing about a text.
    return Model(languages, np.log(smooth / smooth.sum(axis=1, keepdims=True)), settings)


def _scores(column, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sums of log-probabilities by text and language, and n-grams by text."""
    rows = len(column)
    total, grams_of = np.zeros((rows, len(model.languages))), np.zeros(rows, np.int64)
    for points, doc, carried in _parts(column, model.settings):
        bucket, owner = grams(points, doc, model.settings, carried)
        if not len(bucket):
            continue
        lo = int(doc[0])
        grams_of += np.bincount(owner, minlength=rows)
        for k, row in enumerate(model.log_probability):
            total[lo:, k] += np.bincount(owner - lo, weights=row[bucket], minlength=rows - lo)
    return total, grams_of


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score``; the score is the language's share of the mean likelihoods."""

    def each(batch):
        total, n = _scores(batch.column("text"), model)
        langs = np.full(len(n), UNDETERMINED, dtype=object)
        score = np.zeros(len(n))
        known = np.flatnonzero(n) if model.languages else []
        if len(known):
            # A text's n-grams overlap, so their number says too much; its root serves instead.
            scaled = total[known] / np.sqrt(n[known])[:, None]
            odds = np.exp(scaled - scaled.max(axis=1, keepdims=True))
            langs[known] = np.array(model.languages, dtype=object)[odds.argmax(axis=1)]
            score[known] = odds.max(axis=1) / odds.sum(axis=1)
        yield {"doc_id": batch.column("doc_id"), "lang_pred": langs.tolist(), "score": score}

    texts = columns_as(docs, doc_id=("doc_id", "bigint"), text=("text", "string"))
    return map_arrow(texts, "doc_id bigint, lang_pred string, score double", each)


def identify(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Predicts every row with a model learned from the rows that are not held out."""
    held = hold_out(F.col("doc_id"), FOLDS, 0)
    out = predict(docs, train(docs.where(~held), settings))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
