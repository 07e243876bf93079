import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from oracle import compare, connect
from samples import SF, bag

from residua.llm import repair
from residua.llm.queries import QUERIES, SQL

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part int, audit string, gone boolean"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
ROLE = {"u": "user", "a": "assistant"}


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        if not last:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if last[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, marks):
    """Least cost and least edits, row by row and state by state, with the repaired rows."""
    best = {"": (0, "", ())}

    def insert(best):
        for _ in range(3):
            for state, (cost, audit, made) in list(best.items()):
                to = NEXT[state]
                offer = (cost + 2, audit + "I", (*made, (ROLE[to], "")))
                if to not in best or offer[:2] < best[to][:2]:
                    best[to] = offer
        return best

    for (role, text), mark in zip(rows, marks):
        after = {}

        def offer(state, value):
            if state not in after or value[:2] < after[state][:2]:
                after[state] = value

        extra = mark == "truncated"
        for state, (cost, audit, made) in insert(best).items():
            offer(state, (cost + 3, audit + "D", made))
            if mark not in ("blank", "duplicate"):
                offer(NEXT[state], (cost + 2 + extra, audit + "R", (*made, (ROLE[NEXT[state]], text))))
                initial = role[:1]
                if initial and (initial == NEXT[state] or (initial == "s" and state == "")):
                    offer(initial, (cost + extra, audit + "K", (*made, (role, text))))
        best = after
    return min((v for k, v in insert(best).items() if k in ("", "a")), key=lambda v: v[:2])


def by_hand(conv_id, rows):
    """``rows``: turn, role, text, in any order."""
    rows = sorted(
        ((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()),
    )
    turns = {t for t, _, _ in rows if t is not None}
    plain = [(r, x) for _, r, x in rows]
    marks = faults(plain)
    cost, audit, made = cheapest(plain, marks)
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(plain, plain[1:])]
    text = "\n".join(f"{r}:{x}" for r, x in made)
    return (
        conv_id, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(marks.count(m) for m in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
    ), made


def harmed(rows):
    out: dict = {}
    for conv_id, turn, role, text in rows:
        here = out.setdefault(conv_id, [])
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        mode = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if mode == 0:
            continue
        text = "" if mode == 1 else re.sub("[.!?]", "", text) if mode == 2 else text
        here += [(turn, "user" if mode == 4 else role, text)] * (2 if mode == 3 else 1)
    return out


def some_rows(seed=1, conversations=150):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        turn = 0
        for _ in range(rng.randrange(0, 14)):
            turn += rng.choice([0, 1, 1, 1, 1, 3])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            text = rng.choice(["Fine.", "What?", "cut off", "", " \t", "again!", None, f"number {turn}.", f"number {turn}"])
            rows.append((c, rng.choice([turn] * 9 + [None]), role, text))
    return rows + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (None, None, None, None)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", False) for r in rows], SCHEMA)


def test_against_plain_version(spark):
    rows = some_rows()
    grouped: dict = {}
    for c, *rest in rows:
        grouped.setdefault(c, []).append(rest)
    want = [by_hand(c, r) for c, r in grouped.items()]
    got = repair.repair_report(frame(spark, rows).repartition(5))
    assert bag(got) == sorted((w[0] for w in want), key=repr)
    made = repair.repaired(frame(spark, rows)).where("edit <> 'D'")
    lines: dict = {}
    for r in sorted(made.collect(), key=lambda r: r.place):
        assert r.place == len(lines.setdefault(r.conv_id, []))
        lines[r.conv_id].append((r.role, r.text))
    assert lines == {w[0][0]: list(w[1]) for w in want if w[1]}


def test_damage(spark):
    rows = [r for r in some_rows(2, 300)]
    got: dict = {}
    for r in repair.damaged(frame(spark, rows)).collect():
        got.setdefault(r.conv_id, [])
        if not r.gone:
            got[r.conv_id].append((r.turn, r.role, r.text))
    want = harmed(rows)
    assert {k: sorted(v, key=repr) for k, v in got.items()} == {k: sorted(v, key=repr) for k, v in want.items()}
    assert any(not v for v in want.values())
    report = bag(repair.repair_report(repair.damaged(frame(spark, rows))))
    assert report == sorted((by_hand(k, v)[0] for k, v in want.items()), key=repr)


def test_every_short_conversation():
    """All sequences of five symbols: cost and edits against trying all edits."""
    rows = {s: ("sua"[s // 3] if s // 3 < 3 else "x", ("", "truncated", "blank")[s % 3]) for s in range(12)}
    for symbols in product(range(12), repeat=4):
        plain = [(rows[s][0], "") for s in symbols]
        cost, audit, _ = cheapest(plain, [rows[s][1] for s in symbols])
        assert repair.edits([(s, 1) for s in symbols]) == (cost, audit)


@pytest.mark.parametrize("seed", range(20))
def test_runs_advance_by_powers(seed):
    rng = random.Random(seed)
    runs = [(rng.randrange(12), rng.choice([1, 2, 7, 63, 64, 2500])) for _ in range(6)]
    flat = [(s, 1) for s, n in runs for _ in range(n)]
    assert repair.edits(runs) == repair.edits(flat)


def test_long_conversation_is_read_by_several_tasks(spark, conf):
    """One conversation with most rows: same result however the rows are dealt."""
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(3)
    rows = [(7, t // 2, rng.choice(["user", "assistant", "tool"]), rng.choice(["Same.", f"text {t}.", "open"])) for t in range(400)]
    rows += [(c, t, "user", "Same.") for c in (6, 8) for t in range(3)]
    grouped: dict = {}
    for c, *rest in rows:
        grouped.setdefault(c, []).append(rest)
    assert bag(repair.repair_report(frame(spark, rows))) == sorted((by_hand(c, r)[0] for c, r in grouped.items()), key=repr)


def test_empty_tables(spark):
    none = frame(spark, [])
    assert repair.repair_report(repair.damaged(none)).collect() == []
    assert repair.repaired(none).collect() == []
    gone = spark.createDataFrame([(1, 1, "user", "x", 1, "x", True)], SCHEMA)
    assert bag(repair.repair_report(gone)) == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_query_matches_sql(spark):
    name = "op11_run_length_repair"
    assert compare(QUERIES[name](spark, SF), connect(SF), SQL[name]) is None
