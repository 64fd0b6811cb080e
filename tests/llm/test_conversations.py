"""Conversation repair against a plain dynamic programme over all edits."""

import hashlib
import re
from collections import defaultdict
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF001
from watchtide.llm import conversations as C
from watchtide.llm.registry import queries

SPACE = " \t\n\x0b\x0c\r"
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
COLS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def broken(rows):
    text = lambda x: " " if x is None else str(x)
    out = defaultdict(list)
    for conv, turn, role, t in rows:
        rule = crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        role, t = text(role), text(t)
        mine = out[conv]
        if rule == 0:
            continue
        t = "" if rule == 1 else re.sub("[.!?]", "", t) if rule == 2 else t
        mine += [(turn, "user" if rule == 4 else role, t)] * (2 if rule == 3 else 1)
    return out


def closed(states):
    for _ in range(4):
        for q in list(states):
            for x, role in (("u", "user"), ("a", "assistant")):
                if (q, x) in STEP:
                    c, a, o = states[q]
                    new = (c + 5, a + "I", [*o, role + ":"])
                    r = STEP[q, x]
                    if r not in states or new[:2] < states[r][:2]:
                        states[r] = new
    return states


def plain(rows):
    rows = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).hexdigest()))
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, t in rows:
        end = t.rstrip(SPACE)[-1:]
        faults.append("b" if not end else "d" if (role, t) in seen else "t" if end not in ".!?" else "")
        seen.add((role, t))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    states = closed({0: (0, "", [])})
    for (_, role, t), fault in zip(rows, faults):
        new = {}

        def put(q, x):
            if q not in new or x[:2] < new[q][:2]:
                new[q] = x

        more = 5 * (fault == "t")
        for q, (c, a, o) in states.items():
            put(q, (c + 2, a + "D", o))
            if fault not in ("b", "d"):
                kept = STEP.get((q, role[0])) if role else q
                if kept is not None:
                    put(kept, (c + more, a + "K", [*o, f"{role}:{t}"]))
                for x, other in (("u", "user"), ("a", "assistant")):
                    if (q, x) in STEP:
                        put(STEP[q, x], (c + 1 + more, a + "R", [*o, f"{other}:{t}"]))
        states = closed(new)
    cost, audit, out = min((states[q] for q in (0, 3) if q in states), key=lambda x: x[:2])
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def same(df, rows, **options):
    got = {r.conv_id: tuple(r[c] for c in COLS) for r in C.op13_repair(df, **options).collect()}
    assert got == {conv: plain(x) for conv, x in broken(rows).items()}
    return got


def test_whole_query_against_a_plain_programme(spark):
    df = spark.read.parquet(f"{SF001}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    want = {conv: plain(x) for conv, x in broken(rows).items()}
    assert {r.conv_id: tuple(r[c] for c in COLS) for r in queries()["op13_conversation_repair"](spark, SF001).collect()} == want


def odd_rows():
    """A conversation of many rows, one without an id, turns that repeat or are missing, odd roles."""
    roles = ["user", "assistant", "system", None, "", "tool", "agent", "user", "assistant"]
    texts = ["Yes.", "No", "So be it!", "", None, "  \n", "What?", "the same.", "Ends. \t"]
    return [(7 if i % 2 else None if i % 4 == 0 else i // 40, None if i % 29 == 0 else i // 3, roles[i * 5 % 9], f"{texts[i * 7 % 9]}" if i % 11 else texts[i % 9])
            for i in range(900)]


@pytest.mark.parametrize("block, fan", [(3, 2), (50, 3), (256, 16)])
def test_long_conversations_are_taken_apart_and_joined(spark, block, fan):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, cost int, audit string")
    got = same(df, rows, block=block, fan=fan)
    assert len(got[7][6]) > 300


def test_defined_cases(spark):
    assert C.op13_repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
    dropped = [t for t in range(200) if crc32(f"1:{t}".encode()) % 20 == 0][:2]
    kept = [t for t in range(200) if crc32(f"2:{t}".encode()) % 20 > 4]
    rows = [(1, t, "user", "Gone.") for t in dropped] + [(2, kept[0], "user", "x. " * 200_000), (2, kept[1], "assistant", "y." * 300_000)]
    got = same(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), rows)
    assert got[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[2][5:7] == (0, "KK")


def test_repeats_of_one_row_without_an_end(spark):
    """One conversation of a single row, a thousand times."""
    t = next(t for t in range(100) if crc32(f"5:{t}".encode()) % 20 > 4)
    rows = [(5, t, "user", "Hello.")] * 1000
    got = same(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), rows, block=64, fan=4)
    assert got[5][2] == 999 and got[5][6].count("D") >= 999


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.sampled_from(["A.", "b", "", "C!"])), min_size=1, max_size=9), st.integers(1, 8))
def test_blocks_joined_are_the_whole(rows, cut):
    whole = [(i, r, t) for i, (r, t) in enumerate(rows)]
    faults, seen = [], set()
    for r, t in rows:
        faults.append("b" if not t else "d" if (r, t) in seen else "t" if t[-1] not in ".!?" else "")
        seen.add((r, t))
    steps = C.row_steps([(r, f) for (r, _), f in zip(rows, faults)])
    (_, (cost, audit, _, _)), = C.lightest(steps, 0, True, C.GOALS).items()
    parts = [steps[i:i + cut] for i in range(0, len(steps), cut)]
    blocks = []
    for part in parts:
        by = {p: [] for p in range(C.STATES)}
        for w in C._ways(part, True):
            by[w["p"]].append((w["q"], w["cost"], w["audit"]))
        blocks.append(by)
    (_, (cost2, audit2, before, lengths)), = C.lightest(blocks, 0, False, C.GOALS).items()
    assert (cost, audit) == (cost2, audit2)
    out, at, row = [], 0, 0
    for state, end, part in zip(before, lengths, parts):
        out += C.apply(rows[row:row + len(part)], audit[at:end], state)
        at, row = end, row + len(part)
    assert out == C.apply(rows, audit, 0)
    order = plain([(i, r, t) for i, r, t in whole])
    assert (order[5], order[6]) == (cost, audit)
