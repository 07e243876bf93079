"""Removes long passages that repeat anywhere, with suffix trees of prefix-partitioned suffixes.

A window is 35 consecutive words. Every window holds an anchor, the run of 12 of its words
with the least hash (the leftmost such), and equal windows hold equal anchors at equal places.
So the suffixes that begin at windows are partitioned by anchors: consecutive windows with one
anchor travel together as a span of words. Spans whose anchor no other span has are dropped
before their words are moved. A group of spans with the same anchor fits in memory; the nodes
of its suffix tree are found depth by depth (1, 2, 4 ... 35 words), and a node of full depth
with two leaves or more is a passage that repeats. Where too many spans share an anchor, the
prefix is made longer, up to the whole window, and each window is a suffix of its own, which
Spark counts in the tasks before the shuffle.

Equal texts are worked on once: all windows of a text that has copies repeat. So do windows
that occur twice in one text; of these the first stands for all in the index.

Defined results: a null or empty text has no words and nothing is removed. Fewer than 35 words
hold no window. Rows that repeat are copies of each other. An empty table gives no rows. Other
columns are ignored by ``remove_repeats`` and kept by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.workspace import new_path, on_delete, stored, stored_alone
from .tasks import map_arrow, map_arrow_partition
from .words import U64, Words, blocks, covered, hash_windows, mix, repeated


@dataclass(frozen=True)
class Settings:
    window: int = 35
    anchor: int = 12
    # Spans in one suffix tree; beyond that the prefix is made longer.
    group: int = 10_000


# Words of one run of tree building; a group is never cut.
_WORDS_AT_ONCE = 2_000_000
# A place is a tag of 12 bits above the number of a word; one more bit marks hot spans.
_PLACE_BITS = 47
_ORDER_BITS = 28


@dataclass
class Spans:
    """Runs of windows with one anchor: text, first window, number of windows, hash of the anchor."""

    doc: np.ndarray
    first: np.ndarray
    n: np.ndarray
    hash: np.ndarray


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    size, out = 1, values
    while 2 * size <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def spans_of(w: Words, settings: Settings) -> Spans:
    """The spans of all texts of a block; a window that occurred before in its text is left out."""
    at, hashes = w.windows(settings.window)
    empty = np.zeros(0, np.int64)
    if not len(at):
        return Spans(empty, empty, empty, np.zeros(0, U64))
    doc = w.doc_of_word[at]
    first = np.zeros(len(at), bool)
    first[np.unique(mix(hashes ^ mix(doc.astype(U64))), return_index=True)[1]] = True
    runs = hash_windows(w.hashes, settings.anchor)
    order = (runs >> U64(_ORDER_BITS) << U64(_ORDER_BITS)) | np.arange(len(runs), dtype=U64)
    anchor = (_least(order, settings.window - settings.anchor + 1) & U64((1 << _ORDER_BITS) - 1)).astype(np.int64)[at]
    at, anchor, doc = at[first], anchor[first], doc[first]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    return Spans(doc[begin], at[begin] - w.ptr[doc[begin]], np.diff(np.append(begin, len(at))), runs[anchor[begin]])


def texts_of(docs: DataFrame) -> DataFrame:
    """Every distinct text once, bucketed by ``k, tag`` so that later joins leave it in place.

    ``k`` is a hash of the text and ``tag`` part of a second one; both together identify it.
    ``n_rows`` counts its copies, which are added up in the tasks before the shuffle, and that
    shuffle deals the rows out as the buckets want them: a task writes one file a bucket. Called
    within ``stored_alone``, which deletes the table and its entry in the catalog.
    """
    spark = docs.sparkSession
    keyed = docs.select(*text_key(), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    once = keyed.groupBy("k", "tag").agg(F.count("*").alias("n_rows"), F.first("text").alias("text"))
    path = new_path(spark, "texts")
    name = on_delete(path, f"residua_{path.rsplit('/', 1)[1].replace('-', '_')}")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    once.write.option("path", path).format("parquet").bucketBy(parts, "k", "tag").saveAsTable(name)
    return spark.table(name)


def text_key() -> tuple:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.xxhash64(text).alias("k"), F.conv(F.substring(F.md5(text.cast("binary")), 1, 3), 16, 10).cast("int").alias("tag")


def _anchors(texts: DataFrame, settings: Settings) -> DataFrame:
    """``hash, k, place``: the anchor of every span; the place holds tag and first window."""

    def each(batch):
        k = batch.column("k").to_numpy()
        tag = batch.column("tag").to_numpy().astype(np.int64)
        for w in blocks(batch.column("text")):
            spans = spans_of(w, settings)
            doc = spans.doc + w.first
            yield {"hash": spans.hash.view(np.int64), "k": k[doc], "place": tag[doc] << _PLACE_BITS | spans.first}

    return map_arrow(texts.select("k", "tag", "text"), "hash bigint, k bigint, place bigint", each)


def _contents(wanted: DataFrame, settings: Settings) -> DataFrame:
    """``hash, k, place, words, hot`` of the wanted spans; the hashes of their words are packed."""

    def each(batch):
        k, tag = batch.column("k").to_numpy(), batch.column("tag").to_numpy().astype(np.int64)
        lists = batch.column("places")
        bounds, places = lists.offsets.to_numpy(), lists.values.to_numpy()
        for w in blocks(batch.column("text")):
            spans = spans_of(w, settings)
            hashes = w.hashes.astype("<u8")
            sets: dict[int, dict[int, int]] = {}
            out: dict[str, list] = {name: [] for name in ("hash", "k", "place", "words", "hot")}
            for doc, first, n, anchor in zip(spans.doc.tolist(), spans.first.tolist(), spans.n.tolist(), spans.hash.view(np.int64).tolist()):
                row = doc + w.first
                if row not in sets:
                    sets[row] = {p >> 1: p & 1 for p in places[bounds[row] : bounds[row + 1]].tolist()}
                place = int(tag[row]) << _PLACE_BITS | first
                hot = sets[row].get(place)
                if hot is None:
                    continue
                lo = int(w.ptr[doc]) + first
                for name, value in zip(out, (anchor, int(k[row]), place, hashes[lo : lo + n + settings.window - 1].tobytes(), bool(hot))):
                    out[name].append(value)
            if out["k"]:
                yield out

    return map_arrow(wanted, "hash bigint, k bigint, place bigint, words binary, hot boolean", each)


def deep_nodes(words: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Flags the suffixes that share a node of ``depth`` words with another.

    ``starts`` are places in ``words`` with at least ``depth`` words behind them. Suffixes get
    the number of their node at depth 1, then 2, 4 and so on from the nodes of half the depth.
    """
    def number(values: np.ndarray) -> np.ndarray:
        order = np.argsort(values, kind="stable")
        new = np.ones(len(values), np.int64)
        new[1:] = values[order][1:] != values[order][:-1]
        out = np.empty(len(values), np.int64)
        out[order] = np.cumsum(new) - 1
        return out

    node, reach = number(words), 1
    while reach < depth:
        step = min(reach, depth - reach)
        pair = node[: len(node) - step] << 32 | node[step:]
        node, reach = number(pair), reach + step
    return repeated(node[starts])


def _flat(rows: pa.Table, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all spans in a row, window starts, and the span and number of each window."""
    column = rows.column("words").combine_chunks()
    words = np.frombuffer(b"".join(column.to_pylist()), "<u8")
    sizes = np.array([len(x) // 8 for x in column.to_pylist()])
    n = sizes - window + 1
    span = np.repeat(np.arange(len(rows)), n)
    number = np.arange(len(span)) - np.repeat(np.cumsum(n) - n, n)
    return words, np.repeat(np.cumsum(sizes) - sizes, n) + number, span, number


def _stretches(k: np.ndarray, place: np.ndarray, length: int) -> dict:
    """Covered stretches of words from repeating windows; windows that follow one another join."""
    order = np.lexsort((place, k))
    k, place = k[order], place[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (place[1:] != place[:-1] + 1)
    begin = np.flatnonzero(new)
    n = np.diff(np.append(begin, len(k)))
    return {"k": k[begin], "place": place[begin], "n": n + length - 1}


def _subtrees(spans: DataFrame, settings: Settings) -> DataFrame:
    """``k, place, n``: stretches that repeat, from whole groups of spans."""

    def grouped(batches) -> Iterator[pa.Table]:
        rest = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            rest = part if rest is None else pa.concat_tables([rest, part])
            if rest.column("words").nbytes < 8 * _WORDS_AT_ONCE:
                continue
            hashes = rest.column("hash").to_numpy()
            others = np.flatnonzero(hashes != hashes[-1])
            cut = int(others[-1]) + 1 if len(others) else 0
            if cut:
                yield rest.slice(0, cut)
                rest = rest.slice(cut).combine_chunks()
        if rest is not None and len(rest):
            yield rest

    def whole(batches):
        for rows in grouped(batches):
            words, starts, span, number = _flat(rows, settings.window)
            deep = deep_nodes(words, starts, settings.window)
            k, place = rows.column("k").to_numpy(), rows.column("place").to_numpy()
            yield _stretches(k[span[deep]], place[span[deep]] + number[deep], settings.window)

    return map_arrow_partition(
        spans.repartition("hash").sortWithinPartitions("hash").select("hash", "k", "place", "words"),
        "k bigint, place bigint, n bigint", whole,
    )


def _windows(spans: DataFrame, settings: Settings) -> DataFrame:
    """``one, two, k, place``: every window of the spans by two hashes of all its words."""

    def each(batch):
        rows = pa.Table.from_batches([batch])
        words, starts, span, number = _flat(rows, settings.window)
        one, two = (hash_windows(x, settings.window)[starts].view(np.int64) for x in (words, mix(words + U64(1))))
        yield {"one": one, "two": two, "k": rows.column("k").to_numpy()[span], "place": rows.column("place").to_numpy()[span] + number}

    return map_arrow(spans.select("k", "place", "words"), "one bigint, two bigint, k bigint, place bigint", each)


def stretches(texts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``k, place, n``: words of distinct texts covered by windows that other texts hold too."""
    spark = texts.sparkSession
    shared = stored(
        spark, _anchors(texts, settings).groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
        .select("hash", (F.col("n") > settings.group).alias("hot")), "anchors",
    )
    # Hits are narrow; a hot anchor's are split by adaptive execution, as both sides are scans.
    hits = _anchors(texts, settings).join(shared, "hash")
    tag = F.shiftright("place", _PLACE_BITS).cast("int").alias("tag")
    coded = F.shiftleft("place", 1).bitwiseOR(F.col("hot").cast("bigint"))
    places = hits.groupBy("k", tag).agg(F.collect_list(coded).alias("places"))
    spans = stored(spark, _contents(texts.join(places, ["k", "tag"]).select("k", "tag", "text", "places"), settings), "spans")
    cold = _subtrees(spans.where("not hot"), settings)
    # Copies of a passage agree in all words, so they are counted before they are moved.
    suffixes = _windows(spans.where("hot"), settings)
    deep = stored(spark, suffixes.groupBy("one", "two").agg(F.count("*").alias("c")).where("c > 1").select("one", "two"), "suffixes")
    hot = suffixes.join(deep, ["one", "two"]).select("k", "place", F.lit(settings.window).cast("bigint").alias("n"))
    return cold.unionAll(hot)


def _kept(w: Words, i: int, copies: int, places: np.ndarray, lengths: np.ndarray, local: np.ndarray, window: int) -> np.ndarray:
    """Flags the words of text ``i`` that stay."""
    n = int(w.counts[i])
    if n < window:
        return np.ones(n, bool)
    if copies > 1:
        return np.zeros(n, bool)
    gone = covered(local - w.ptr[i], window, n)
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, places, 1)
    np.add.at(steps, places + lengths, -1)
    return ~(gone | (np.cumsum(steps[:-1]) > 0))


def _kept_text(w: Words, i: int, keep: np.ndarray, whole_runs: bool) -> bytes:
    """The words that stay, by one space; or the stretches that stay as they were, by one space."""
    starts, ends = (x[w.ptr[i] : w.ptr[i + 1]] for x in w.spans)
    if whole_runs:
        edge = np.diff(np.concatenate([[0], keep.astype(np.int8), [0]]))
        starts, ends = starts[np.flatnonzero(edge == 1)], ends[np.flatnonzero(edge == -1) - 1]
    else:
        starts, ends = starts[keep], ends[keep]
    data, base = w.text(i), int(w.offsets[i])
    return b" ".join([data[a - base : b - base] for a, b in zip(starts.tolist(), ends.tolist())])


def applied(texts: DataFrame, found: DataFrame, settings: Settings, with_text: bool) -> DataFrame:
    """What stays of each distinct text: counts, and its digest or its new text if it changed."""
    tag = F.shiftright("place", _PLACE_BITS).cast("int").alias("tag")
    per_text = found.groupBy("k", tag).agg(F.collect_list(F.struct("place", "n")).alias("s")).select(
        "k", "tag", F.col("s.place").alias("places"), F.col("s.n").alias("lengths")
    )
    rows = texts.join(per_text, ["k", "tag"], "left").select("k", "tag", "n_rows", "text", "places", "lengths")
    mask = (1 << _PLACE_BITS) - 1

    def each(batch):
        copies = batch.column("n_rows").to_numpy()
        places, lengths = batch.column("places"), batch.column("lengths")
        for w in blocks(batch.column("text")):
            at, hashes = w.windows(settings.window)
            doc = w.doc_of_word[at]
            again = repeated(mix(hashes ^ mix(doc.astype(U64))))
            local, local_doc = at[again], doc[again]
            edges = np.searchsorted(local_doc, np.arange(w.n_docs + 1))
            out: dict[str, list] = {name: [] for name in ("k", "tag", "n_words", "n_removed", "kept_sha256", "kept_text")}
            for i in range(w.n_docs):
                row = w.first + i
                p = np.array(places[row].as_py() or [], np.int64)
                size = np.array(lengths[row].as_py() or [], np.int64)
                keep = _kept(w, i, copies[row], p & mask, size, local[edges[i] : edges[i + 1]], settings.window)
                removed = len(keep) - int(keep.sum())
                out["n_words"].append(len(keep))
                out["n_removed"].append(removed)
                if with_text:
                    out["kept_sha256"].append(None)
                    out["kept_text"].append(_kept_text(w, i, keep, True).decode() if removed else None)
                else:
                    out["kept_sha256"].append(hashlib.sha256(_kept_text(w, i, keep, False)).hexdigest())
                    out["kept_text"].append(None)
            out["k"] = batch.column("k").slice(w.first, w.n_docs)
            out["tag"] = batch.column("tag").slice(w.first, w.n_docs)
            yield out

    return map_arrow(rows, "k bigint, tag int, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string", each)


def remove_repeats(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row of ``docs``."""
    def build() -> DataFrame:
        texts = texts_of(docs)
        return applied(texts, stretches(texts, settings), settings, False).drop("kept_text")

    done = stored_alone(docs.sparkSession, build, "kept")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *text_key())
    return rows.join(done, ["k", "tag"]).select("doc_id", "n_words", "n_removed", "kept_sha256")


def without_repeats(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with the repeating passages cut out of ``text``; all rows and columns stay."""
    def build() -> DataFrame:
        texts = texts_of(docs)
        done = applied(texts, stretches(texts, settings), settings, True).where("n_removed > 0")
        return done.select(F.col("k").alias("_k"), F.col("tag").alias("_tag"), "kept_text")

    changed = stored_alone(docs.sparkSession, build, "cut-texts")
    # Copies of a text may be a large part of the rows, so the rows move and hot keys can be split.
    k, tag = text_key()
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    joined = docs.select(whole, k.alias("_k"), tag.alias("_tag")).join(changed, ["_k", "_tag"], "left")
    return joined.select(*[
        (F.coalesce("kept_text", "row.text") if name == "text" else F.col(f"row.`{name}`")).alias(name) for name in docs.columns
    ])
