"""Quality rules by distance of a document's histograms from those of its language.

Two histograms are taken of each text: its characters by class, and its words by the most
common short words of its language, all others together. The references cover all texts of
the language: of each class of characters the median of the texts' shares, so that up to half
of the texts may be unlike prose without moving it far, and of the words the sums. A text is
rejected if the Jensen-Shannon distance to a reference is too large and the text is long enough
for it to mean something.

Defined results: a null text counts as empty and has no words, so the base rule rejects it.
Rows with a null language form a language of their own; a language without references is judged
by the base rule alone. Repeated rows are judged alike, each
for itself. An empty table gives no rows. Ties between common words go to the word that comes
first in byte order. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tasks import columns_as, map_arrow, map_arrow_partition
from .words import U64, Words, blocks, covered, hash_words, mix, repeated

REPEAT_WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20

# Character classes: a-z, A-Z, digits, white space, marks of ordinary prose, other ASCII,
# and everything beyond ASCII.
LOWER_CASE, UPPER_CASE, DIGIT, SPACE, MARK, SYMBOL, BEYOND, CONTINUED = range(8)
N_CLASSES = CONTINUED
PROSE_MARKS = b".,;:?'\"()-"
_CLASS = np.full(256, SYMBOL, np.int64)
_CLASS[ord("a") : ord("z") + 1] = LOWER_CASE
_CLASS[ord("A") : ord("Z") + 1] = UPPER_CASE
_CLASS[ord("0") : ord("9") + 1] = DIGIT
_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
_CLASS[list(PROSE_MARKS)] = MARK
_CLASS[0xC0:] = BEYOND
_CLASS[0x80:0xC0] = CONTINUED
CLASS_NAMES = ["lower_case", "upper_case", "digit", "space", "mark", "symbol", "beyond"]

# Counted as symbols by the base rule.
_BASE_SYMBOL = np.zeros(256, np.int64)
_BASE_SYMBOL[list(b"#*$%&|<>")] = 1

# A text's share of a class is counted in so many steps.
SHARE_STEPS = 4096

# A word can be a common word if it has at most this many characters, all of them letters.
SHORT = 6
_LETTER = np.zeros(256, np.int64)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_START_OF_CHAR = np.ones(256, np.int64)
_START_OF_CHAR[0x80:0xC0] = 0


@dataclass(frozen=True)
class Rules:
    """Parameters. The number of languages bounds what is sent to every task."""

    n_common: int = 32
    max_char_distance: float = 0.165
    max_word_distance: float = 0.31
    min_chars: int = 200
    min_words: int = 100
    min_reference_words: int = 200
    max_languages: int = 10_000


@dataclass
class References:
    """Histograms by language; ``''`` is the null language, others have a ``=`` in front."""

    languages: list[str] = field(default_factory=list)
    chars: np.ndarray = field(default_factory=lambda: np.zeros((0, N_CLASSES)))
    words: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    slots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


def _language():
    return F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("lang")


def _classes(w: Words) -> np.ndarray:
    """Characters of each text by class."""
    classes = _CLASS[w.data]
    flat = np.repeat(np.arange(w.n_docs), np.diff(w.offsets)) * (N_CLASSES + 1) + classes
    return np.bincount(flat, minlength=w.n_docs * (N_CLASSES + 1)).reshape(-1, N_CLASSES + 1)[:, :N_CLASSES]


def _short_words(w: Words) -> np.ndarray:
    """Indices of the words that can be common words."""
    starts, ends = w.spans
    close = np.flatnonzero(ends - starts <= 4 * SHORT)
    chars = w.per_doc(_START_OF_CHAR[w.data], np.stack([starts[close], ends[close]]))[0]
    letters = w.per_doc(_LETTER[w.data], np.stack([starts[close], ends[close]]))[0]
    return close[(chars <= SHORT) & (letters == (ends - starts)[close])]


def _counted(batches):
    """Per language: texts by their share of each class, words, and counts of short words."""
    shares: dict[tuple[str, int, int], int] = {}
    totals: dict[str, int] = {}
    shorts: dict[tuple[str, bytes], int] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for w in blocks(batch.column("text")):
            names, index = np.unique(np.array(langs[w.first : w.first + w.n_docs], dtype=object).astype(str), return_inverse=True)
            by_class, short = _classes(w), _short_words(w)
            filled = by_class.sum(axis=1)
            steps = SHARE_STEPS * by_class // np.maximum(filled, 1)[:, None]
            starts, ends = w.spans
            hashes = hash_words(w.data, starts[short], ends[short]) if len(short) else np.zeros(0, U64)
            owner = index[w.doc_of_word[short]]
            for k, name in enumerate(names):
                name = str(name)
                for kind in range(N_CLASSES):
                    step, n = np.unique(steps[(index == k) & (filled > 0), kind], return_counts=True)
                    for key, more in zip(step.tolist(), n.tolist()):
                        shares[name, kind, key] = shares.get((name, kind, key), 0) + more
                totals[name] = totals.get(name, 0) + int(w.counts[index == k].sum())
                own = owner == k
                _, at, n = np.unique(hashes[own], return_index=True, return_counts=True)
                for i, c in zip(short[own][at], n):
                    key = (name, w.data[starts[i] : ends[i]].tobytes())
                    shorts[key] = shorts.get(key, 0) + int(c)
            if len(shorts) > 500_000:
                yield _short_rows(shorts)
                shorts = {}
    yield _short_rows(shorts)
    rows = [(name, str(kind), f"{step:04d}", n) for (name, kind, step), n in shares.items()]
    rows += [(name, "words", "", n) for name, n in totals.items()]
    yield dict(zip(("lang", "kind", "word", "n"), (list(c) for c in zip(*rows)))) if rows else _short_rows({})


def _short_rows(shorts: dict) -> dict:
    return {
        "lang": [k[0] for k in shorts], "kind": ["short"] * len(shorts),
        "word": [k[1].decode() for k in shorts], "n": list(shorts.values()),
    }


def reference_counts(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``lang, kind, word, n``: the references of all languages, a bounded number of rows each.

    Counts cover all texts. They are added up in the tasks before the shuffle. The row of a class
    of characters holds the median share, the least that half of the texts with characters keep to.
    """
    texts = columns_as(docs, text=("text", "string"), lang=("lang", "string")).select("text", _language())
    counted = map_arrow_partition(texts, "lang string, kind string, word string, n bigint", _counted)
    sums = counted.groupBy("lang", "kind", "word").agg(F.sum("n").alias("n"))
    words = sums.where(F.col("kind").isin("short", "words"))
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "word"))
    # The words' total is one row, so one limit holds for both kinds; Spark applies it before
    # the shuffle of the window as well.
    words = words.withColumn("_rank", rank).where(F.col("_rank") <= rules.n_common).drop("_rank")
    # A class has at most as many rows as there are steps.
    by_class = Window.partitionBy("lang", "kind")
    upto = by_class.orderBy("word").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shares = sums.where(~F.col("kind").isin("short", "words")).select(
        "lang", "kind", "word", F.sum("n").over(upto).alias("_upto"), F.sum("n").over(by_class).alias("_all")
    )
    median = shares.where(2 * F.col("_upto") >= F.col("_all")).groupBy("lang", "kind").agg(F.min("word").cast("bigint").alias("n"))
    return words.unionByName(median.select("lang", "kind", F.lit("").alias("word"), "n"))


def references(docs: DataFrame, rules: Rules = Rules()) -> References:
    """The references as arrays: at most ``max_languages`` times the histogram sizes."""
    rows_per_language = N_CLASSES + 1 + rules.n_common
    found = reference_counts(docs, rules).limit(rules.max_languages * rows_per_language + 1).collect()
    languages = sorted({r["lang"] for r in found})
    if len(languages) > rules.max_languages or len(found) > rules.max_languages * rows_per_language:
        raise ValueError(f"more than {rules.max_languages} languages; raise max_languages")
    index = {name: i for i, name in enumerate(languages)}
    out = References(languages, np.zeros((len(languages), N_CLASSES)), np.zeros((len(languages), rules.n_common + 1)))
    short = sorted((r for r in found if r["kind"] == "short"), key=lambda r: (index[r["lang"]], -r["n"], r["word"].encode()))
    keys, slots, taken = [], [], dict.fromkeys(languages, 0)
    for r in found:
        if r["kind"] == "words":
            out.words[index[r["lang"]], -1] += r["n"]
        elif r["kind"] != "short":
            out.chars[index[r["lang"]], int(r["kind"])] = r["n"]
    for r in short:
        i, slot = index[r["lang"]], taken[r["lang"]]
        taken[r["lang"]] += 1
        out.words[i, slot] = r["n"]
        out.words[i, -1] -= r["n"]
        word = np.frombuffer(r["word"].encode(), np.uint8)
        keys.append(_keyed(hash_words(word, np.array([0]), np.array([len(word)])), np.array([i]))[0])
        slots.append(slot)
    order = np.argsort(np.array(keys, U64))
    out.keys, out.slots = np.array(keys, U64)[order], np.array(slots, np.int64)[order]
    return out


def _keyed(hashes: np.ndarray, language: np.ndarray) -> np.ndarray:
    return mix(hashes ^ mix(language.astype(U64) + U64(1)))


def js_distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row to the row of the reference, from 0 to 1."""
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    q = reference / np.maximum(reference.sum(axis=1, keepdims=True), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return np.sqrt(np.clip(terms.sum(axis=1) / 2, 0, 1))


def _common_words(w: Words, language: np.ndarray, refs: References) -> np.ndarray:
    """Words of each text by the common words of its language, all others last."""
    width = refs.words.shape[1]
    keys = _keyed(w.hashes, language[w.doc_of_word])
    at = np.minimum(np.searchsorted(refs.keys, keys), max(len(refs.keys) - 1, 0))
    slot = np.where(refs.keys[at] == keys, refs.slots[at], width - 1) if len(refs.keys) else np.full(len(keys), width - 1)
    return np.bincount(w.doc_of_word * width + slot, minlength=w.n_docs * width).reshape(-1, width)


def _duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def _repeat_words(w: Words) -> np.ndarray:
    at, hashes = w.windows(REPEAT_WINDOW)
    again = at[repeated(mix(hashes ^ mix(w.doc_of_word[at].astype(U64))))]
    return w.per_doc(covered(again, REPEAT_WINDOW, len(w.hashes)), w.ptr)


def _judged(batch, refs: References, rules: Rules):
    known = {name: i for i, name in enumerate(refs.languages)}
    # The last row is that of languages without references.
    languages = np.array([known.get(x, len(known)) for x in batch.column("lang").to_pylist()], np.int64)
    by_chars, by_words = (np.concatenate([x, np.zeros((1, x.shape[1]))]) for x in (refs.chars, refs.words))
    for w in blocks(batch.column("text")):
        language = languages[w.first : w.first + w.n_docs]
        n_words, repeats = w.counts, _repeat_words(w)
        failed = (n_words < MIN_WORDS) | (100 * repeats > REPEAT_PERCENT * n_words)
        chars = _classes(w)
        by_char = js_distance(chars, by_chars[language])
        by_word = js_distance(_common_words(w, language, refs), by_words[language])
        bad = (by_words[language].sum(axis=1) >= rules.min_reference_words) & (
            ((chars.sum(axis=1) >= rules.min_chars) & (by_char > rules.max_char_distance))
            | ((n_words >= rules.min_words) & (by_word > rules.max_word_distance))
        )
        lines = np.zeros(w.n_docs, np.int64)
        for i in np.flatnonzero(w.per_doc(w.data == 10, w.offsets)):
            lines[i] = _duplicate_lines(w.text(i))
        yield {
            "doc_id": batch.column("doc_id").slice(w.first, w.n_docs),
            "n_words": n_words,
            "word_chars": w.per_doc(w.is_word * _START_OF_CHAR[w.data], w.offsets),
            "n_symbols": w.per_doc(_BASE_SYMBOL[w.data], w.offsets),
            "n_dup_lines": lines,
            "n_repeat_words": repeats,
            "base_failed": failed,
            "char_distance": by_char,
            "word_distance": by_word,
            "kept": ~failed & ~bad,
        }


def judge(docs: DataFrame, refs: References, rules: Rules = Rules()) -> DataFrame:
    """Counts, distances and the verdict ``kept`` for every row of ``docs``; no shuffle."""
    texts = columns_as(docs, doc_id=("doc_id", "bigint"), text=("text", "string"), lang=("lang", "string")).select("doc_id", "text", _language())
    return map_arrow(
        texts,
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, char_distance double, word_distance double, kept boolean",
        lambda batch: _judged(batch, refs, rules),
    )


def divergence_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Judges every document against references taken from all of them."""
    return judge(docs, references(docs, rules), rules)
