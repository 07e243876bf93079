"""Packs token sequences into windows of fixed size by minimum bin slack.

A document's tokens are cut at multiples of the window size. What is left over has one of
``capacity - 1`` lengths, so the whole packing problem is a histogram of that many counts.
For each window the longest left-over length is taken, and a subset-sum dynamic program over
the other lengths, as bits of one integer per length, finds the multiset that comes closest
to the capacity; its counts are backtracked, and the pattern is used for as many windows as
the histogram allows. The pieces then find their place by their number among the pieces of
their length, without meeting in one task.

Defined results: a null or empty text is one piece, the end token alone. Repeated rows are
packed once each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..plans.workspace import stored
from .tasks import columns_as, map_arrow, map_arrow_partition
from .vocabulary import DEFAULT_PATH, SPLIT_PATTERN, vocabulary
from .words import text_bytes

CAPACITY = 2048
END_ID = 1


class Ids:
    """Token ids of texts.

    The tokenizers library defines them. Where the file's ids are the ranks of its merges,
    tiktoken gives the same ids from the same file four times as fast; a text that it cannot
    take goes to the library.
    """

    def __init__(self, path: str) -> None:
        words = vocabulary(path)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        ranked = sorted(words.byte_ids) == list(range(256)) and all(
            merged == 256 + i for i, (_, _, merged) in enumerate(words.merges)
        )
        ranks = {words.token_bytes[i]: i for i in words.ids.values()} if ranked else {}
        self.special = list(words.special)
        self.fast = tiktoken.Encoding(
            "own", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={}
        ) if ranked else None

    def __call__(self, text: str) -> array:
        if self.fast and not any(s in text for s in self.special):
            try:
                return array("I", self.fast.encode_ordinary(text))
            except BaseException as error:  # its native code panics on some very long runs
                if type(error).__name__ != "PanicException" and not isinstance(error, Exception):
                    raise
        return array("I", self.library.encode(text, add_special_tokens=False).ids)


@lru_cache(maxsize=2)
def ids_of(path: str = DEFAULT_PATH) -> Ids:
    return Ids(path)


def cut(docs: DataFrame, path: str = DEFAULT_PATH, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` and the piece's number.

    ``nth`` numbers the pieces of one length within the task ``task``.
    """

    def whole(batches):
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            rows, starts, lengths, crcs, totals = [], [], [], [], []
            for i in range(len(offsets) - 1):
                ids = ids_of(path)(data[offsets[i] : offsets[i + 1]].tobytes().decode())
                ids.append(END_ID)
                raw, n = np.frombuffer(ids, np.uint32).astype("<u4", copy=False).tobytes(), len(ids)
                for at in range(0, n, capacity):
                    length = min(capacity, n - at)
                    rows.append(i)
                    starts.append(at)
                    lengths.append(length)
                    crcs.append(zlib.crc32(raw[4 * at : 4 * (at + length)]))
                    totals.append(n)
            nth = np.empty(len(rows), np.int64)
            for k, length in enumerate(lengths):
                nth[k] = seen[length]
                seen[length] += 1
            yield {
                "doc_id": batch.column("doc_id").take(rows), "start": starts, "length": lengths,
                "ids_crc32": crcs, "doc_tokens": totals, "task": [task] * len(rows), "nth": nth,
            }

    texts = columns_as(docs, doc_id=("doc_id", "bigint"), text=("text", "string"))
    return map_arrow_partition(
        texts,
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, task int, nth bigint",
        whole,
    )


def fill(counts: np.ndarray, capacity: int) -> list[int]:
    """Copies of each length that fill one window best, the longest length first.

    ``counts[n]`` pieces have length ``n``. Bit ``s`` of ``reach`` says that some multiset
    of the lengths so far sums to ``s``.
    """
    use = [0] * (capacity + 1)
    longest = int(np.flatnonzero(counts)[-1])
    use[longest] = 1
    room = capacity - longest
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        left = min(int(counts[length]) - use[length], room // length)
        chunk = 1
        while left > 0:
            take = min(chunk, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            chunk *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    for length, take, before in reversed(steps):
        # The sum can be reached without this step or it needs it.
        if not before >> total & 1:
            use[length] += take
            total -= length * take
    return use


@dataclass
class Plan:
    """Patterns of windows by length: at most a few times ``capacity`` squared entries, whatever the data.

    Pieces of a length are numbered from 0. Run ``k`` of the length takes the numbers from
    ``first[k]``, ``each[k]`` per window; its windows begin at ``window[k]`` and its pieces
    in them at ``offset[k]``.
    """

    lengths: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    windows: int


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """Patterns that place all pieces; each has as many windows as the counts allow."""
    counts = counts.copy()
    taken = np.zeros_like(counts)
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    windows = 0
    while counts.any():
        use = fill(counts, capacity)
        lengths = [n for n in range(capacity, 0, -1) if use[n]]
        times = min(int(counts[n]) // use[n] for n in lengths)
        offset = 0
        for n in lengths:
            runs.setdefault(n, []).append((int(taken[n]), use[n], windows, offset))
            offset += n * use[n]
            taken[n] += times * use[n]
            counts[n] -= times * use[n]
        windows += times
    return Plan({n: tuple(np.array(x, np.int64) for x in zip(*r)) for n, r in runs.items()}, windows)


def place(pieces: DataFrame, packing: Plan) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` from ``length`` and ``number``."""

    def each(batch):
        length = batch.column("length").to_numpy(zero_copy_only=False)
        number = batch.column("number").to_numpy(zero_copy_only=False)
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
            if not len(rows):
                continue
            n = int(length[rows[0]])
            first, per, window, start = packing.lengths[n]
            run = np.searchsorted(first, number[rows], "right") - 1
            within = number[rows] - first[run]
            sequence[rows] = window[run] + within // per[run]
            offset[rows] = start[run] + within % per[run] * n
        out = {name: batch.column(name) for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
        yield out | {"sequence_id": sequence, "offset": offset}

    return map_arrow(
        pieces,
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
        each,
    )


def pack(docs: DataFrame, path: str = DEFAULT_PATH, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its place; each id lies in exactly one piece.

    The numbers of the pieces are written with them, so a task that runs again gives the
    same places. What reaches the driver is one count per length.
    """
    spark = docs.sparkSession
    pieces = stored(spark, cut(docs, path, capacity), "pieces")
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(
        spark, by_task.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "piece-numbers"
    )
    counts = np.zeros(capacity + 1, np.int64)
    for row in bases.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    numbered = pieces.join(bases.drop("n"), ["length", "task"]).withColumn("number", F.col("base") + F.col("nth"))
    return place(numbered, plan(counts, capacity))
