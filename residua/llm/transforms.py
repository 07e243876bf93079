"""Removes long byte strings that repeat anywhere, by merging Burrows-Wheeler transforms of shards.

A window is 400 consecutive bytes of one text. Every window holds an anchor, the run of 32 of its
bytes with the least hash (the leftmost such), and equal windows hold equal anchors at equal
places. Consecutive windows with one anchor are a span; spans whose anchor no other span has
hold no repeat. Equal spans, which copied passages consist of, are counted by their hashes in
the tasks and are never moved. Only where an anchor has several different contents, one span of
each is moved to a task that takes whole groups of one anchor.

There the spans are dealt into shards. A symbol is a run of 50 bytes, and the symbol before a
place is the one that ends where it begins, so 50 interleaved strings of symbols hold all
suffixes of a span, and a window is eight symbols deep. Each shard has its suffixes sorted to
that depth and its transform built once. The transforms are merged by refining their interleave:
one pass over the merged symbols, stable by symbol, turns the interleave that is right for
prefixes of ``h`` symbols into the one for ``h + 1``, and the places where neighbours first
part give the lengths of common prefixes. What has not parted after eight symbols is an interval
of windows that repeat. No suffix is compared or sorted again.

An anchor with very many different contents, as a phrase of common use may be, is worked on
window by window: windows are counted by two hashes of all their bytes, in the tasks first.

Defined results: a null or empty text has no bytes and nothing is removed; fewer than 400 bytes
hold no window. Rows that repeat are copies of each other, and all of a copy of 400 bytes or more
goes. A repeat within one text counts, also where it overlaps itself. An empty table gives no
rows. Other columns are ignored by ``remove_repeated_bytes`` and kept by ``without_repeated_bytes``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.workspace import stored, stored_alone
from .substrings import text_key, texts_of
from .tasks import map_arrow, map_arrow_partition
from .words import U64, WORD_BASE, hash_windows, mix, powers, text_bytes


@dataclass(frozen=True)
class Settings:
    """``window`` is a multiple of ``symbol``, ``gram`` of 8 and less than ``window``."""

    window: int = 400
    symbol: int = 50
    gram: int = 32
    # Different contents of one anchor that are merged in one task; windows are counted beyond it.
    group: int = 4000
    # Symbols of a shard, and bytes of spans that are merged at a time; a group is never cut.
    shard: int = 1 << 18
    run: int = 1 << 21


# Window starts that are worked on at a time.
_STRIP = 1 << 18
# A place is a tag of 12 bits above the number of a byte.
_PLACE_BITS = 47
_GRAM_FACTOR = U64(0x9FB21C651E98DF25)


@dataclass
class Spans:
    """Runs of windows with one anchor: text, first window, number of windows, and two hashes."""

    doc: np.ndarray
    first: np.ndarray
    n: np.ndarray
    hash: np.ndarray
    content: np.ndarray


@cache
def _both_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(WORD_BASE, n), powers(U64(pow(int(WORD_BASE), -1, 1 << 64)), n)


def _eights(data: np.ndarray) -> np.ndarray:
    """The number that each run of eight bytes makes."""
    n = len(data) - 7
    out = np.empty(n, U64)
    for r in range(min(8, n)):
        here = out[r::8]
        here[:] = np.frombuffer(data[r : r + 8 * len(here)].tobytes(), "<u8")
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    size, out = 1, values
    while 2 * size <= width:
        out, size = np.minimum(out[:-size], out[size:]), 2 * size
    rest = width - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _in_strip(data: np.ndarray, valid: np.ndarray, settings: Settings) -> tuple:
    """First valid window, number of windows, hash of anchor and of content of a strip's spans."""
    at = np.flatnonzero(valid)
    grams = mix(_eights(data))
    n = len(data) - settings.gram + 1
    joint = np.zeros(n, U64)
    for i in range(settings.gram // 8):
        joint = (joint ^ grams[8 * i : 8 * i + n]) * _GRAM_FACTOR
    joint = mix(joint)
    bits = U64(len(joint).bit_length())
    order = joint >> bits << bits | np.arange(n, dtype=U64)
    anchor = (_least(order, settings.window - settings.gram + 1)[at] & ((U64(1) << bits) - U64(1))).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(at)))
    first = at[begin]
    # A hash of all bytes of each span, from sums along the strip.
    up, down = _both_powers(_STRIP + settings.window)
    sums = np.concatenate([[U64(0)], np.cumsum(grams * up[: len(grams)])])
    size = count + settings.window - 1
    content = mix((sums[first + size - 7] - sums[first]) * down[first] ^ mix(size.astype(U64)))
    return first, count, joint[anchor[begin]], content


def spans_of(data: np.ndarray, offsets: np.ndarray, settings: Settings) -> Iterator[Spans]:
    """The spans of all texts, a strip of window starts at a time.

    A span may end where a strip does; that costs work, as its content is another, but no repeat.
    """
    ends = offsets[1:]
    for lo in range(int(offsets[0]), int(offsets[-1]) - settings.window + 1, _STRIP):
        hi = min(lo + _STRIP, int(offsets[-1]) - settings.window + 1)
        a = int(np.searchsorted(ends, lo, "right"))
        b = int(np.searchsorted(ends, hi, "right")) + 1
        last = np.clip(ends[a:b] - settings.window + 1, lo, hi) - lo
        begin = np.clip(offsets[a:b], lo, hi) - lo
        edges = np.zeros(hi - lo + 1, np.int32)
        full = last > begin[: len(last)]
        np.add.at(edges, begin[: len(last)][full], 1)
        np.add.at(edges, last[full], -1)
        valid = np.cumsum(edges[:-1]) > 0
        if not valid.any():
            continue
        first, n, anchor, content = _in_strip(data[lo : hi + settings.window - 1], valid, settings)
        doc = np.searchsorted(ends, first + lo, "right")
        yield Spans(doc, first + lo - offsets[doc], n, anchor, content)


def _spans(texts: DataFrame, settings: Settings) -> DataFrame:
    """``hash, content, k, place, n`` of every span of the distinct texts."""

    def each(batch):
        k, tag = batch.column("k").to_numpy(), batch.column("tag").to_numpy().astype(np.int64)
        for s in spans_of(*text_bytes(batch.column("text")), settings):
            yield {
                "hash": s.hash.view(np.int64), "content": s.content.view(np.int64), "k": k[s.doc],
                "place": tag[s.doc] << _PLACE_BITS | s.first, "n": s.n,
            }

    rows = texts.where(F.octet_length("text") >= settings.window).select("k", "tag", "text")
    return map_arrow(rows, "hash bigint, content bigint, k bigint, place bigint, n int", each)


def _bytes(wanted: DataFrame, settings: Settings) -> DataFrame:
    """``hash, k, place, once, hot, data``: the bytes of the wanted spans of each text."""

    def each(batch):
        data, offsets = text_bytes(batch.column("text"))
        lists = batch.column("spans")
        bounds = lists.offsets.to_numpy()
        field = {name: lists.values.field(name).to_numpy(zero_copy_only=False) for name in ("hash", "place", "n", "once", "hot")}
        rows = np.repeat(np.arange(len(batch)), np.diff(bounds))
        at = np.arange(bounds[0], bounds[-1])
        start = (field["place"][at] & ((1 << _PLACE_BITS) - 1)) + offsets[rows]
        end = start + field["n"][at] + settings.window - 1
        k = batch.column("k").to_numpy()[rows]
        lo = 0
        while lo < len(at):
            size = np.cumsum(end[lo:] - start[lo:])
            hi = lo + max(1, int(np.searchsorted(size, settings.run, "right")))
            yield {name: field[name][at[lo:hi]] for name in ("hash", "place", "once", "hot")} | {
                "k": k[lo:hi], "data": [data[a:b].tobytes() for a, b in zip(start[lo:hi].tolist(), end[lo:hi].tolist())],
            }
            lo = hi

    return map_arrow(wanted, "hash bigint, k bigint, place bigint, once boolean, hot boolean, data binary", each)


def _stable(values: np.ndarray) -> np.ndarray:
    """Stable order of numbers below ``2 ** 32``, by their halves."""
    order = np.argsort((values & 0xFFFF).astype(np.uint16), kind="stable")
    if len(values) and values.max() >> 16:
        order = order[np.argsort((values[order] >> 16).astype(np.uint16), kind="stable")]
    return order


@dataclass
class Transform:
    """Suffixes of a shard in order of their symbols, and the symbol before each, -1 for none.

    The ``n_ends`` empty suffixes come first; each of them is its own, so a suffix that ends
    within the depth equals no other.
    """

    suffix: np.ndarray
    before: np.ndarray
    n_ends: int


def transform(symbols: np.ndarray, depth: int) -> Transform:
    """The transform of a shard, whose strings of symbols stand one behind another.

    Each string ends with -1. Ranks for 1, 2, 4 and so on symbols come from those for half as many.
    """
    ends = symbols < 0
    n_ends = int(ends.sum())
    rank = np.where(ends, np.cumsum(ends) - 1, symbols + n_ends)
    reach = 1
    while reach < depth:
        more = min(reach, depth - reach)
        behind = np.zeros(len(rank), np.int64)
        behind[:-more] = rank[more:]
        # A suffix that has ended before is told apart by its end already.
        pair = np.where(ends, 0, rank) << 32 | behind
        order = np.argsort(pair)
        new = np.ones(len(order), np.int64)
        new[1:] = pair[order][1:] != pair[order][:-1]
        after = np.empty(len(order), np.int64)
        after[order] = np.cumsum(new) - 1
        rank, reach = np.where(ends, rank, after + n_ends), reach + more
    order = np.argsort(rank)
    before = np.append(-1, symbols[:-1])
    return Transform(order, before[order], n_ends)


def merge(shards: list[Transform], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard by shard the merged place of each suffix, and the common prefixes of neighbours.

    The second array has, for each merged place, how many symbols that suffix shares with the
    one before it, ``depth`` at most.
    """
    n_ends = sum(t.n_ends for t in shards)
    sizes = [len(t.suffix) - t.n_ends for t in shards]
    owner = np.concatenate([
        np.repeat(np.arange(len(shards), dtype=np.uint16), [t.n_ends for t in shards]),
        np.repeat(np.arange(len(shards), dtype=np.uint16), sizes),
    ])
    symbols = np.concatenate([t.before for t in shards])
    # Before the first symbol nothing is told apart, then each empty suffix is.
    block = np.zeros(len(owner), np.int64)
    common = np.full(len(owner), depth, np.int64)
    common[: n_ends + 1] = 0
    for h in range(1, depth + 1):
        # The next symbols of each shard are taken in the order in which the shard is called.
        called = np.argsort(owner, kind="stable")
        before = np.empty(len(owner), np.int64)
        before[called] = symbols
        source = np.flatnonzero(before >= 0)
        source = source[_stable(before[source])]
        part = (before[source][1:] != before[source][:-1]) | (block[source][1:] != block[source][:-1])
        parted = n_ends + 1 + np.flatnonzero(part)
        common[parted] = np.minimum(common[parted], h - 1)
        owner = np.concatenate([owner[:n_ends], owner[source]])
        block = np.concatenate([np.arange(n_ends), n_ends + np.concatenate([[0], np.cumsum(part)])[: len(source)]])
    return np.argsort(owner, kind="stable"), common


def _strings(data: list[bytes], step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of all spans, string by string, their span and first byte, and how often each occurs.

    A string takes every ``step``-th place of a span, so that its symbols stand side by side,
    and ends with -1, where no symbol fits any more.
    """
    size = np.array([len(x) for x in data])
    base = np.cumsum(size + 1) - size - 1
    flat = np.frombuffer(b"".join(x + b"\0" for x in data), np.uint8)
    span = np.repeat(np.arange(len(data)), size + 1)
    local = np.arange(len(flat)) - base[span]
    each, rest = np.divmod(size + 1, step)
    row, column = np.divmod(local, step)
    place = base[span] + column * each[span] + np.minimum(column, rest[span]) + row
    fits = np.flatnonzero(local + step <= size[span])
    values, times = np.unique(hash_windows(flat.astype(U64) + U64(1), step)[fits], return_inverse=True, return_counts=True)[1:]
    symbols, counts = np.full(len(flat), -1, np.int64), np.zeros(len(flat), np.int64)
    symbols[place[fits]], counts[place[fits]] = values, times[values]
    ordered_span, ordered_local = np.empty_like(span), np.empty_like(local)
    ordered_span[place], ordered_local[place] = span, local
    return symbols, ordered_span, ordered_local, counts


def repeated_windows(data: list[bytes], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Which windows of the spans occur more than once among them: span and first byte."""
    depth = settings.window // settings.symbol
    symbols, span, local, counts = _strings(data, settings.symbol)
    # A symbol that occurs once is in no window that repeats: strings are cut there.
    edge = np.diff(np.concatenate([[0], (counts > 1).astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - begin >= depth
    inside = np.zeros(len(symbols) + 1, np.int8)
    inside[begin[long]], inside[end[long]] = 1, -1
    stays = np.cumsum(inside[:-1]) > 0
    stays[end[long]] = True
    symbols[end[long]] = -1
    symbols, span, local = symbols[stays], span[stays], local[stays]
    empty = np.zeros(0, np.int64)
    if not len(symbols):
        return empty, empty
    ends = np.flatnonzero(symbols < 0) + 1
    edges = [0, *ends[np.flatnonzero(np.diff(ends // settings.shard, append=-1))].tolist()]
    shards = [transform(symbols[a:b], depth) for a, b in zip(edges[:-1], edges[1:])]
    place, common = merge(shards, depth)
    # Intervals of suffixes that share all symbols of a window with a neighbour.
    whole = common >= depth
    inside = whole | np.append(whole[1:], False)
    suffix = np.concatenate([t.suffix + a for t, a in zip(shards, edges)])
    found = suffix[inside[place]]
    found = found[np.lexsort((local[found], span[found]))]
    return span[found], local[found]


def _stretches(k: np.ndarray, place: np.ndarray, length: int) -> dict:
    """Covered stretches of bytes from repeating windows; windows that follow one another join."""
    order = np.lexsort((place, k))
    k, place = k[order], place[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (place[1:] != place[:-1] + 1)
    begin = np.flatnonzero(new)
    return {"k": k[begin], "place": place[begin], "n": np.diff(np.append(begin, len(k))) + length - 1}


def _merged(spans: DataFrame, settings: Settings) -> DataFrame:
    """``k, place, n``: stretches of spans that occur once, from whole groups of one anchor."""

    def grouped(batches) -> Iterator[pa.Table]:
        parts: list[pa.Table] = []
        size = 0
        for batch in batches:
            parts.append(pa.Table.from_batches([batch]))
            size += batch.column("data").nbytes
            if size < settings.run:
                continue
            rest = pa.concat_tables(parts).combine_chunks()
            hashes = rest.column("hash").to_numpy()
            # Groups are given out as soon as they fill a run.
            bounds = np.append(np.flatnonzero(np.diff(hashes)) + 1, len(hashes))
            filled = np.cumsum([len(x) for x in rest.column("data").to_pylist()])[bounds - 1]
            lo = done = 0
            for bound, total in zip(bounds[:-1].tolist(), filled[:-1].tolist()):
                if total - done >= settings.run or bound == bounds[-2]:
                    yield rest.slice(lo, bound - lo)
                    lo, done = bound, total
            parts = [rest.slice(lo).combine_chunks()]
            size = int(filled[-1] - done)
        if parts:
            yield pa.concat_tables(parts)

    def whole(batches):
        for rows in grouped(batches):
            if len(rows):
                span, first = repeated_windows(rows.column("data").to_pylist(), settings)
                once = rows.column("once").to_numpy()[span]
                k, place = rows.column("k").to_numpy(), rows.column("place").to_numpy()
                yield _stretches(k[span[once]], (place[span] + first)[once], settings.window)

    dealt = spans.repartition("hash").sortWithinPartitions("hash").select("hash", "k", "place", "once", "data")
    return map_arrow_partition(dealt, "k bigint, place bigint, n bigint", whole)


def _windows(spans: DataFrame, settings: Settings) -> DataFrame:
    """``one, two, k, place, once``: every window of the spans by two hashes of all its bytes."""

    def each(batch):
        for i, data in enumerate(batch.column("data").to_pylist()):
            values = np.frombuffer(data, np.uint8).astype(U64) + U64(1)
            one, two = (hash_windows(x, settings.window).view(np.int64) for x in (values, mix(values)))
            n = len(one)
            yield {
                "one": one, "two": two, "k": np.repeat(batch.column("k")[i].as_py(), n),
                "place": batch.column("place")[i].as_py() + np.arange(n), "once": np.repeat(batch.column("once")[i].as_py(), n),
            }

    return map_arrow(spans.select("k", "place", "once", "data"), "one bigint, two bigint, k bigint, place bigint, once boolean", each)


def stretches(texts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``k, place, n``: bytes of distinct texts that are covered by windows that repeat."""
    spark = texts.sparkSession
    spans = stored(spark, _spans(texts, settings), "byte-spans")
    shared = spans.groupBy("hash").agg(F.count("*").alias("m"), (F.min("content") != F.max("content")).alias("mixed"))
    # As both sides of the joins are scans, a hot anchor's rows are split by adaptive execution.
    shared = stored(spark, shared.where("m > 1").select("hash", "mixed"), "byte-anchors")
    hits = stored(spark, spans.join(shared, "hash").select("hash", "content", "k", "place", "n", "mixed"), "byte-hits")
    covered = F.col("n").cast("bigint") + (settings.window - 1)
    plain = hits.where("not mixed").select("k", "place", covered.alias("n"))
    contents = stored(
        spark,
        hits.where("mixed").groupBy("hash", "content").agg(F.count("*").alias("m"), F.min(F.struct("k", "place", "n")).alias("first")),
        "byte-contents",
    )
    equal = hits.where("mixed").join(contents.where("m > 1").select("hash", "content"), ["hash", "content"])
    equal = equal.select("k", "place", covered.alias("n"))
    # One span of each content goes on, as a witness if all its copies are covered already.
    hot = contents.groupBy("hash").count().where(F.col("count") > settings.group).select("hash", F.lit(True).alias("hot"))
    hot = stored(spark, hot, "byte-hot")
    chosen = contents.join(hot, "hash", "left").select(
        "hash", "first.k", "first.place", "first.n", (F.col("m") == 1).alias("once"), F.coalesce("hot", F.lit(False)).alias("hot")
    )
    tag = F.shiftright("place", _PLACE_BITS).cast("int").alias("tag")
    of_text = chosen.groupBy("k", tag).agg(F.collect_list(F.struct("hash", "place", "n", "once", "hot")).alias("spans"))
    data = stored(spark, _bytes(texts.join(of_text, ["k", "tag"]).select("k", "text", "spans"), settings), "byte-contents")
    merged = _merged(data.where("not hot"), settings)
    windows = _windows(data.where("hot"), settings)
    again = windows.groupBy("one", "two").agg(F.count("*").alias("m")).where("m > 1").select("one", "two")
    again = stored(spark, again, "byte-windows")
    counted = windows.where("once").join(again, ["one", "two"]).select("k", "place", F.lit(settings.window).cast("bigint").alias("n"))
    return plain.unionAll(equal).unionAll(merged).unionAll(counted)


def applied(texts: DataFrame, found: DataFrame, settings: Settings) -> DataFrame:
    """``k, tag, n_bytes, n_removed, n_spans, kept`` of each distinct text; ``kept`` is binary."""
    tag = F.shiftright("place", _PLACE_BITS).cast("int").alias("tag")
    per_text = found.groupBy("k", tag).agg(F.collect_list(F.struct("place", "n")).alias("spans"))
    rows = texts.join(per_text, ["k", "tag"], "left").select(
        "k", "tag", (F.col("n_rows") > 1).alias("copied"), "text",
        F.col("spans.place").alias("places"), F.col("spans.n").alias("lengths"),
    )
    mask = (1 << _PLACE_BITS) - 1

    def each(batch):
        data, offsets = text_bytes(batch.column("text"))
        copied = batch.column("copied").to_numpy(zero_copy_only=False)
        sides = [batch.column(name) for name in ("places", "lengths")]
        bounds = sides[0].offsets.to_numpy()
        places, lengths = (side.values.to_numpy() for side in sides)
        lo = 0
        while lo < len(batch):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + settings.run, "right")) - 1)
            hi = min(hi, len(batch))
            out: dict[str, list] = {name: [] for name in ("n_bytes", "n_removed", "n_spans", "kept")}
            for i in range(lo, hi):
                text = data[offsets[i] : offsets[i + 1]]
                a, b = _union(places[bounds[i] : bounds[i + 1]] & mask, lengths[bounds[i] : bounds[i + 1]])
                if copied[i] and len(text) >= settings.window:
                    a, b = np.array([0]), np.array([len(text)])
                keep = zip([0, *b.tolist()], [*a.tolist(), len(text)])
                values = (len(text), int((b - a).sum()), len(a), b"".join([text[x:y].tobytes() for x, y in keep]))
                for name, value in zip(out, values):
                    out[name].append(value)
            yield out | {name: batch.column(name).slice(lo, hi - lo) for name in ("k", "tag")}
            lo = hi

    return map_arrow(rows, "k bigint, tag int, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary", each)


def _union(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs that the stretches cover; stretches that touch are one run."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(start, kind="stable")
    start = start[order]
    end = np.maximum.accumulate(start + length[order])
    new = np.append(True, start[1:] > end[:-1])
    return start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def remove_repeated_bytes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row of ``docs``."""
    def build() -> DataFrame:
        texts = texts_of(docs)
        cut = applied(texts, stretches(texts, settings), settings)
        return cut.select("k", "tag", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

    done = stored_alone(docs.sparkSession, build, "cut-bytes")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *text_key())
    return rows.join(done, ["k", "tag"]).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def without_repeated_bytes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with ``text`` as the bytes that stay (binary, as a cut may split a character).

    All rows and other columns stay; a null text is empty.
    """
    def build() -> DataFrame:
        texts = texts_of(docs)
        cut = applied(texts, stretches(texts, settings), settings).where("n_removed > 0")
        return cut.select(F.col("k").alias("_k"), F.col("tag").alias("_tag"), "kept")

    changed = stored_alone(docs.sparkSession, build, "cut-bytes")
    k, tag = text_key()
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    joined = docs.select(whole, k.alias("_k"), tag.alias("_tag")).join(changed, ["_k", "_tag"], "left")
    text = F.coalesce("kept", F.col("row.text").cast("binary"), F.lit(b""))
    return joined.select(*[(text if name == "text" else F.col(f"row.`{name}`")).alias(name) for name in docs.columns])
