"""Repairs the structure of conversations at the least cost, by a dynamic program over runs.

The rows of a conversation are taken by turn (nulls first), then by role and by the md5 hash of
the text. Each has a symbol: the initial of its role and its first fault. The repaired roles
have the initials ``(s?(ua)+)?``, so a program over four states (nothing yet, ``s``, ``u``, ``a``)
gives the cheapest edits. Equal symbols in a row are collapsed into one run, a symbol's step is a
4 x 4 matrix over minimum and sum, and a run advances by the binary powers of that matrix, which
are kept. Then the edits are unrolled from the front, the ASCII-least of the cheapest first.

Rows are dealt by ranges of conversation and turn, so a conversation of any length is read by
several tasks; each gives its runs, a few bytes for each, and only those meet, no more than the
audit that the result holds of them. Rows seen earlier are found by counting in the tasks first.
Texts are moved once, to the stream that makes the repaired rows one after another.

Defined results: null role and text are one space, so such a row is blank. A role that begins
with none of ``s u a``, also an empty one, cannot be kept. Rows that repeat are duplicates,
whatever their turns. A null id is a conversation of its own. Rows with ``gone`` set only make
their conversation known. An empty table gives no rows, a conversation of one row is one like
any other. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.workspace import stored
from .tasks import map_arrow, map_arrow_partition

SPACE = " \t\n\x0b\f\r"
KEPT, TRUNCATED, REMOVED = 0, 1, 2
INITIALS = "sua"
DELETE, INSERT, REROLE, UNFINISHED = 3, 2, 2, 1

_FAR = 1 << 60
_START, _S, _U, _A = range(4)
# The state behind an inserted or renamed row, and its role.
_NEXT = (_U, _U, _A, _U)
_ROLE = {_U: "user", _A: "assistant"}
# What is left to do when all rows are read: the rest of a pair must be inserted.
_END = (0, 2 * INSERT, INSERT, 0)
_BLOCK = 1024


def damaged(conversations: DataFrame) -> DataFrame:
    """Test damage: ``conv_id, turn, role, text, gone`` by the checksum of ``conv_id:turn``.

    Of twenty rows one is dropped (``gone``), one emptied, one loses its ``.!?``, one is repeated
    and one gets the role user. Nulls count as one space.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("mode"),
    )
    mode = F.col("mode")
    return rows.select(
        "conv_id", "turn", F.when(mode == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(mode == 1, "").when(mode == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (mode == 0).alias("gone"), F.explode(F.when(mode == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _rows(conversations: DataFrame) -> DataFrame:
    """``conv_id, gone, turn, role, digest, text`` with nulls in their defined form."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    gone = F.coalesce(F.col("gone"), F.lit(False)) if "gone" in conversations.columns else F.lit(False)
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), gone.alias("gone"), F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"), F.unhex(F.md5(text.cast("binary"))).alias("digest"), text.alias("text"),
    )


def _marked(rows: DataFrame) -> DataFrame:
    """Narrow rows with their symbols; ``seen`` where an earlier turn holds the role and text."""
    bare = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    marks = rows.select(
        "conv_id", "gone", "turn", "role", "digest", (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("open"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).cast("int").alias("initial"),
    )
    place = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("at"))
    again = marks.where("not gone").groupBy("conv_id", "role", "digest").agg(F.count("*").alias("m"), F.min(place).alias("first")).where("m > 1")
    again = again.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    met = (F.col("conv_id").eqNullSafe(F.col("c"))) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    return marks.join(again, met, "left").select(
        "conv_id", (~F.col("gone")).alias("here"), "turn", "role", "digest", "blank", "open", "initial",
        F.coalesce(F.col("first") < place, F.lit(False)).alias("seen"),
    )


_PART = (
    "conv_id bigint, part bigint, symbols binary, lengths array<bigint>, blank bigint, duplicate bigint, "
    "truncated bigint, illegal bigint, least bigint, most bigint, turns bigint"
)
# Rows that are gone come first, as their flag is negated.
_ORDER = ["conv_id", "here", "turn", "role", "digest"]


def _equal_to_previous(column: pa.Array, before) -> np.ndarray:
    """Flags values equal to the one before; ``before`` is the last value of the batch before."""
    shifted = pa.concat_arrays([pa.array([before], column.type), column.slice(0, len(column) - 1)])
    same = pc.fill_null(pc.equal(column, shifted), False).to_numpy(zero_copy_only=False)
    return same | (column.is_null().to_numpy(zero_copy_only=False) & shifted.is_null().to_numpy(zero_copy_only=False))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row for each batch and conversation of a sorted partition: its runs and counts."""
    names = ("conv_id", "here", "turn", "role", "digest")
    part, before = TaskContext.get().partitionId() << 32, None
    for batch in batches:
        if not len(batch):
            continue
        column = {name: batch.column(name) for name in batch.schema.names}
        same = {n: _equal_to_previous(column[n], before[n] if before else None) for n in names}
        if before is None:
            same["conv_id"][0] = False
        before = {n: column[n][-1].as_py() for n in names}
        flag = {n: column[n].to_numpy(zero_copy_only=False) for n in ("here", "blank", "open", "seen")}
        twin = np.logical_and.reduce([same[n] for n in names]) & flag["here"]
        fault = np.select([flag["blank"], flag["seen"] | twin, flag["open"]], [1, 2, 3], 0)
        initial = column["initial"].to_numpy().astype(np.int64)
        symbol = initial * 3 + np.array([KEPT, REMOVED, REMOVED, TRUNCATED])[fault]
        begin = np.flatnonzero(~same["conv_id"] | (np.arange(len(batch)) == 0))
        for lo, hi in zip(begin.tolist(), [*begin[1:].tolist(), len(batch)]):
            lo_all, lo = lo, hi - int(flag["here"][lo:hi].sum())
            runs = lo + np.flatnonzero(np.diff(symbol[lo:hi], prepend=-1))
            turns = column["turn"].slice(lo, hi - lo).drop_null()
            counts = np.bincount(fault[lo:hi], minlength=4)
            pair = initial[lo : hi - 1] * 4 + initial[lo + 1 : hi]
            yield {
                "conv_id": column["conv_id"].slice(lo_all, 1), "part": [part],
                "symbols": [symbol[runs].astype(np.uint8).tobytes()], "lengths": [np.diff(np.append(runs, hi)).tolist()],
                "blank": [int(counts[1])], "duplicate": [int(counts[2])], "truncated": [int(counts[3])],
                "illegal": [_illegal(pair)],
                "least": [turns[0].as_py() if len(turns) else None], "most": [turns[-1].as_py() if len(turns) else None],
                "turns": [int(np.count_nonzero(np.diff(turns.to_numpy()))) + 1 if len(turns) else 0],
            }
            part += 1


def _illegal(pairs: np.ndarray) -> int:
    """Pairs of initials other than su, ua and au."""
    return int(np.count_nonzero(~np.isin(pairs, (0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1))))


def _times(one: tuple, two: tuple) -> tuple:
    """Product of two matrices over minimum and sum."""
    return tuple(tuple(min(row[k] + two[k][j] for k in range(4)) for j in range(4)) for row in one)


def _behind(matrix: tuple, rest: tuple) -> tuple:
    """Costs before a step from the costs behind it."""
    return tuple(min(_FAR, *(a + b for a, b in zip(row, rest))) for row in matrix)


def _keeps(symbol: int) -> dict[int, int]:
    """From which state to which a row can be kept."""
    return {_START: {0: _S, 1: _U}.get(symbol // 3), _S: {1: _U}.get(symbol // 3), _U: {2: _A}.get(symbol // 3), _A: {1: _U}.get(symbol // 3)}


@lru_cache(None)
def _step(symbol: int) -> tuple:
    """Least cost from state to state over any inserts and one row."""
    extra = UNFINISHED if symbol % 3 == TRUNCATED else 0
    row = [[_FAR] * 4 for _ in range(4)]
    for state, kept in _keeps(symbol).items():
        row[state][state] = DELETE
        if symbol % 3 != REMOVED:
            row[state][_NEXT[state]] = min(row[state][_NEXT[state]], REROLE + extra)
            if kept is not None:
                row[state][kept] = min(row[state][kept], extra)
    inserted = [[0 if i == j else INSERT if _NEXT[i] == j else 2 * INSERT if _NEXT[_NEXT[i]] == j else _FAR for j in range(4)] for i in range(4)]
    return _times(tuple(map(tuple, inserted)), tuple(map(tuple, row)))


@lru_cache(None)
def _power(symbol: int, bit: int) -> tuple:
    """The step taken ``2 ** bit`` times."""
    return _step(symbol) if not bit else _times(_power(symbol, bit - 1), _power(symbol, bit - 1))


def advance(symbol: int, length: int, rest: tuple) -> tuple:
    """Costs before a run of equal symbols from the costs behind it."""
    for bit in range(length.bit_length()):
        if length >> bit & 1:
            rest = _behind(_power(symbol, bit), rest)
    return rest


def _unrolled(symbol: int, length: int, rest: tuple, state: int, out: list[str]) -> int:
    """Adds the edits of a run to ``out``; gives the state behind it."""
    extra = UNFINISHED if symbol % 3 == TRUNCATED else 0
    keeps, fixed = _keeps(symbol), symbol % 3 == REMOVED
    for lo in range(0, length, _BLOCK):
        n = min(_BLOCK, length - lo)
        costs = [advance(symbol, length - lo - n, rest)]
        for _ in range(n):
            costs.append(_behind(_step(symbol), costs[-1]))
        for i in range(n, 0, -1):
            here, behind = costs[i], costs[i - 1]
            # In the order of the letters; an insert leaves the row where it is.
            while True:
                if DELETE + behind[state] == here[state]:
                    out.append("D")
                elif INSERT + here[_NEXT[state]] == here[state]:
                    out.append("I")
                    state = _NEXT[state]
                    continue
                elif not fixed and keeps[state] is not None and extra + behind[keeps[state]] == here[state]:
                    out.append("K")
                    state = keeps[state]
                else:
                    out.append("R")
                    state = _NEXT[state]
                break
    return state


def edits(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """Least cost, and the ASCII-least of the cheapest edits, of runs of (symbol, length)."""
    rest = [_END]
    for symbol, length in reversed(runs):
        rest.append(advance(symbol, length, rest[-1]))
    rest.reverse()
    state, out = _START, []
    for i, (symbol, length) in enumerate(runs):
        state = _unrolled(symbol, length, rest[i + 1], state, out)
    while _END[state]:
        out.append("I")
        state = _NEXT[state]
    return rest[0][_START], "".join(out)


_few_edits = lru_cache(1 << 14)(lambda runs: edits(list(runs)))

_COUNTED = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _solved(parts: list[dict]) -> dict:
    """Counts, cost and audit of a conversation from its parts in order."""
    out = {name: sum(p[name] for p in parts) for name in ("blank", "duplicate", "truncated", "illegal")}
    runs: list[tuple[int, int]] = []
    least = most = last = None
    turns = 0
    for p in parts:
        for symbol, length in zip(p["symbols"], p["lengths"]):
            if runs and runs[-1][0] == symbol:
                runs[-1] = (symbol, runs[-1][1] + length)
            else:
                runs.append((symbol, length))
        if p["symbols"]:
            first = p["symbols"][0] // 3
            out["illegal"] += 0 if last is None else _illegal(np.array([last * 4 + first]))
            last = p["symbols"][-1] // 3
        if p["turns"]:
            turns += p["turns"] - (p["least"] == most)
            least, most = p["least"] if least is None else least, p["most"]
    out["gaps"] = most - least + 1 - turns if turns else 0
    out["cost"], out["audit"] = _few_edits(tuple(runs)) if len(runs) <= 64 and all(n < 64 for _, n in runs) else edits(runs)
    return out


def audits(conversations: DataFrame) -> DataFrame:
    """``conv_id``, the counts of faults, ``cost`` and ``audit`` of every conversation.

    ``conversations`` has ``conv_id, turn, role, text``, and ``gone`` if some rows are.
    """
    spark = conversations.sparkSession
    marks = _marked(_rows(conversations)).repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    parts = map_arrow_partition(marks, _PART, _parts)
    fields = F.struct("part", *[c for c in parts.columns if c not in ("conv_id", "part")])
    # Runs alone: a conversation's take no more room than the audit of its rows.
    grouped = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(fields)).alias("parts"))

    def each(batch):
        solved = [_solved(p) for p in batch.column("parts").to_pylist()]
        yield {"conv_id": batch.column("conv_id")} | {name: [s[name] for s in solved] for name in _NAMES}

    return stored(spark, map_arrow(grouped, f"conv_id bigint, {_COUNTED}", each), "audits")


_NAMES = [field.split()[0] for field in _COUNTED.split(", ")]


def _in_order(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of each conversation in order behind its audit, in one partition."""
    rows = _rows(conversations).where("not gone")
    head = found.select("conv_id", F.lit(0).alias("kind"), *_NAMES)
    body = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text")
    both = head.unionByName(body, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest").drop("digest")


def _edited(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Walks the rows: ``(head, None)`` at each conversation, then ``(head, (edit, turn, role, text))``."""
    head, letters, at, state = None, "", 0, _START
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                yield from _inserts(head, letters, at, state)
                head, letters, at, state = row, row["audit"], 0, _START
                yield head, None
                continue
            while letters[at] == "I":
                state, at = _NEXT[state], at + 1
                yield head, ("I", None, _ROLE[state], "")
            edit, at = letters[at], at + 1
            if edit == "D":
                yield head, ("D", row["turn"], row["role"], row["text"])
            elif edit == "R":
                state = _NEXT[state]
                yield head, ("R", row["turn"], _ROLE[state], row["text"])
            else:
                state = _S if row["role"][0] == "s" else _NEXT[state]
                yield head, ("K", row["turn"], row["role"], row["text"])
    yield from _inserts(head, letters, at, state)


def _inserts(head, letters: str, at: int, state: int) -> Iterator[tuple]:
    for _ in letters[at:]:
        state = _NEXT[state]
        yield head, ("I", None, _ROLE[state], "")


_OUT_AT_ONCE = 2000


def repaired(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, edit, turn, role, text``: the rows after the edits, by place from 0.

    Deleted rows have a null place; inserted ones a null turn and an empty text.
    """

    def whole(batches):
        names = ("conv_id", "place", "edit", "turn", "role", "text")
        out: dict[str, list] = {n: [] for n in names}
        place = 0
        for head, row in _edited(batches):
            if row is None:
                place = 0
                continue
            for n, value in zip(names, (head["conv_id"], None if row[0] == "D" else place, *row)):
                out[n].append(value)
            place += row[0] != "D"
            if len(out["place"]) >= _OUT_AT_ONCE:
                yield out
                out = {n: [] for n in names}
        yield out

    rows = _in_order(conversations, audits(conversations))
    return map_arrow_partition(rows, "conv_id bigint, place bigint, edit string, turn bigint, role string, text string", whole)


def repair_report(conversations: DataFrame) -> DataFrame:
    """``audits`` and the hash of the repaired ``role:text`` lines of every conversation."""

    def whole(batches):
        names = ("conv_id", *_NAMES, "repaired_sha256")
        out: dict[str, list] = {n: [] for n in names}
        digest = head = None
        for here, row in _edited(batches):
            if row is None:
                if head is not None:
                    for n in names:
                        out[n].append(head.get(n, digest.hexdigest()))
                    if len(out["conv_id"]) >= _OUT_AT_ONCE:
                        yield out
                        out = {n: [] for n in names}
                head, digest, lead = here, hashlib.sha256(), b""
            elif row[0] != "D":
                digest.update(lead + f"{row[2]}:{row[3]}".encode())
                lead = b"\n"
        if head is not None:
            for n in names:
                out[n].append(head.get(n, digest.hexdigest()))
        yield out

    rows = _in_order(conversations, audits(conversations))
    return map_arrow_partition(rows, f"conv_id bigint, {_COUNTED}, repaired_sha256 string", whole)
