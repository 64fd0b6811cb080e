"""Conversation structure repair by Knuth's lightest derivation.

A repaired conversation is what edits of its rows, in order, leave: Keep (0), Rerole to
user or assistant (1), Delete (2; blank and repeated rows must go) and Insert of an empty
turn (5); a truncated row that stays costs 5 more. The initials of its roles have to read
``(s?(ua)+)?``. A hypergraph says what can be derived: item (i, q) means that the first i rows
are repaired and leave the pattern in state q; it follows from (i - 1, p) and an edit of
row i, or from (i, p) and an inserted turn. Its weight is the pair (cost, initials of the
edits). Appending an edit never lowers that pair and keeps its order, so the functions are
monotone and superior, and an agenda finalises every item when it is popped, least first,
until the goal (all rows, in a state the pattern may end in) is popped.

Rows are dealt by ranges of (conversation, turn, role, text) and sorted within, so that a
conversation, however long, is spread over tasks. One that lies within a task and has
at most ``BLOCK`` rows is repaired there. Of the others every block of rows becomes one
deduction for each state before and after it, found by the same agenda; blocks are joined
``FAN`` at a time, level by level, again by the agenda, which now takes whole blocks for
steps. (Deriving a block from a block is the same superior function: at equal cost no
two audits of the same rows are one the prefix of the other, for what is longer has inserted
more.) The final hash reads a conversation's text in order and streams it.

Defined cases: a NULL role or text counts as one space; a NULL turn comes first, a NULL
conversation is one of its own; both are one space in the damage rule's hash. Rows of one
turn are taken by role and then by the text's digest, so that equal ones are adjacent. A role's initial is its first character;
the empty role has none and leaves the pattern where it is. Repeated rows are repeats, long texts
are cut out of blocks by size, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from watchtide.llm.common import cut, slots

BLOCK, BLOCK_CHARS = 256, 1 << 20
SPACE_CHARS = " \t\n\x0b\x0c\r"
FAN = 16
COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED = 5
STATES = 4  # nothing yet, after s, after u, after a
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
GOALS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
PAIRS = {"su", "ua", "au"}


# ---- the agenda -----------------------------------------------------------------------

def lightest(steps: list[dict], start: int, inserts: bool, goals=None):
    """Weights of the items (last row, state) that can be derived from (0, ``start``).

    ``steps[i][p]`` holds (q, cost, audit) for everything that leads from state p over row or
    block i to q. Returns {state: (cost, audit, states before each step, audit's length
    after each step)}; with ``goals``, only for the first of them that is finalised.
    """
    n = len(steps)
    agenda = [(0, "", 0, start, None)]
    final: dict = {}
    found: dict = {}
    while agenda:
        cost, audit, i, q, back = heapq.heappop(agenda)
        if (i, q) in final:
            continue
        final[i, q] = (back, len(audit))
        if i == n:
            if goals is None or q in goals:
                found[q] = (cost, audit)
                if goals is not None or len(found) == STATES:
                    break
        else:
            for r, c, a in steps[i][q]:
                if (i + 1, r) not in final:
                    heapq.heappush(agenda, (cost + c, audit + a, i + 1, r, (i, q)))
        if inserts:
            for x in "ua":
                r = NEXT.get((q, x))
                if r is not None and (i, r) not in final:
                    heapq.heappush(agenda, (cost + COSTS["I"], audit + "I", i, r, (i, q)))
    out = {}
    for q, (cost, audit) in found.items():
        before, lengths, item = [0] * n, [0] * n, (n, q)
        while item is not None:
            back, length = final[item]
            if back is not None and back[0] < item[0]:
                before[back[0]] = back[1]
                lengths[back[0]] = length
            item = back
        out[q] = (cost, audit, before, lengths)
    return out


def row_steps(rows) -> list[dict]:
    """Edits of each row by state: rows of (role, fault)."""
    steps = []
    for role, fault in rows:
        more = TRUNCATED if fault == "t" else 0
        step = {}
        for p in range(STATES):
            ways = [(p, COSTS["D"], "D")]
            if fault not in ("b", "d"):
                kept = p if not role else NEXT.get((p, role[0]))
                if kept is not None:
                    ways.append((kept, COSTS["K"] + more, "K"))
                ways += [(NEXT[p, x], COSTS["R"] + more, "R") for x in "ua" if (p, x) in NEXT]
            step[p] = ways
        steps.append(step)
    return steps


def apply(rows, audit: str, state: int) -> list[str]:
    """The repaired ``role:text`` that an audit makes of rows (role, text), from a state on."""
    out, i = [], 0
    for edit in audit:
        if edit == "I":
            x = "a" if state == 2 else "u"
            out.append(f"{ROLES[x]}:")
        else:
            role, text = rows[i]
            i += 1
            if edit == "D":
                continue
            x = role[:1] if edit == "K" else "a" if state == 2 else "u"
            out.append(f"{role if edit == 'K' else ROLES[x]}:{text}")
            if not x:
                continue
        state = NEXT[state, x]
    return out


# ---- rows of conversations ------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the rule: by crc32(conv_id:turn) % 20 a row is dropped,
    emptied, loses its sentence marks, is repeated, or is given to the user."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rule = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), rule.alias("_r"))
    rows = rows.filter("_r <> 0").select(
        "conv_id", "turn", F.when(F.col("_r") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_r") == 1, F.lit("")).when(F.col("_r") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("_r") == 3, 2).otherwise(1).alias("_n"))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_n"))).drop("_n", "_copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """Add ``id`` (unique), ``digest`` of the text and ``fault``: b, d, t or empty.

    A row is a repeat if it isn't the first of its conversation, role and text: the first is
    found by partial minima, and only of texts that occur more than once.
    """
    rows = rows.select("conv_id", "turn", "role", "text", F.sha2("text", 256).alias("digest"), F.monotonically_increasing_id().alias("id"))
    rows = cut(rows, "conversation-rows")
    key = ["conv_id", "role", "digest"]
    place = F.struct(F.col("turn").isNotNull().alias("t"), F.col("turn").alias("turn"), "id")
    first = rows.groupBy(*key).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    first = first.select(*[F.col(c).alias(f"_{c}") for c in key], F.col("_first.id").alias("_first"))
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    last = F.right(F.rtrim("text", F.lit(SPACE_CHARS)), F.lit(1))
    fault = (F.when(last == "", "b").when(F.col("_first").isNotNull() & (F.col("_first") != F.col("id")), "d")
             .when(~last.isin(".", "!", "?"), "t").otherwise(""))
    return rows.join(first, on, "left").select("conv_id", "turn", "role", "text", "digest", "id", fault.alias("fault"))


class _Block:
    """Rows of one conversation in order, and what can be said of them."""

    def __init__(self, rows: list[tuple]):
        self.rows = [(role, text) for _, role, text, _ in rows]
        self.faults = [f for *_, f in rows]
        turns = [t for t, *_ in rows if t is not None]
        self.low, self.high, self.turns = (turns[0], turns[-1], len(set(turns))) if turns else (None, None, 0)
        initials = [r[:1] for r, _ in self.rows]
        self.first, self.last = initials[0], initials[-1]
        self.illegal = sum(a + b not in PAIRS for a, b in zip(initials, initials[1:], strict=False))
        self.steps = row_steps([(r, f) for (r, _), f in zip(self.rows, self.faults, strict=True)])

    def counts(self) -> list[int]:
        return [self.faults.count(x) for x in "bdt"]


_STATS = "low long, high long, turns long, first string, last string, illegal long, blank long, duplicate long, truncated long"
_WAYS = "ways array<struct<p: int, q: int, cost: long, audit: string, path: array<struct<state: int, size: long>>>>"


def _ways(steps: list[dict], inserts: bool, paths: list[list] | None = None) -> list[dict]:
    """Everything that leads over the steps, for each state before them; paths: those of each step by (p, audit)."""
    out = []
    for p in range(STATES):
        for q, (cost, audit, before, lengths) in lightest(steps, p, inserts).items():
            if paths is None:
                path = [{"state": p, "size": len(audit)}]
            else:
                path, at = [], 0
                for k, (state, end) in enumerate(zip(before, lengths, strict=True)):
                    path += paths[k][state, audit[at:end]]
                    at = end
            out.append({"p": p, "q": q, "cost": cost, "audit": audit, "path": path})
    return out


def _blocks(conv_kind: pa.DataType, block: int):
    """Sorted rows -> repaired conversations, and blocks of those that may not be whole."""

    def run(batches):
        part = TaskContext.get().partitionId() << 33
        schema = pa.schema([("conv_id", conv_kind), ("seq", pa.int64()), ("rows", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
                            ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()), ("first", pa.string()), ("last", pa.string()),
                            ("illegal", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
                            ("ways", pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()),
                                                         ("path", pa.list_(pa.struct([("state", pa.int32()), ("size", pa.int64())])))]))),
                            ("repaired_sha256", pa.string())])
        seq = 0

        def told(conv, rows, whole):
            nonlocal seq
            seq += 1
            b = _Block(rows)
            row = {"conv_id": conv, "seq": part + seq, "rows": None, "low": b.low, "high": b.high, "turns": b.turns, "first": b.first, "last": b.last,
                   "illegal": b.illegal, "repaired_sha256": None} | dict(zip(("blank", "duplicate", "truncated"), b.counts(), strict=True))
            if whole:
                (q, (cost, audit, _, _)), = lightest(b.steps, 0, True, GOALS).items()
                row["ways"] = [{"p": 0, "q": q, "cost": cost, "audit": audit, "path": []}]
                row["repaired_sha256"] = hashlib.sha256("\n".join(apply(b.rows, audit, 0)).encode()).hexdigest()
            else:
                row["ways"] = _ways(b.steps, True)
                row["rows"] = [{"role": r, "text": t} for r, t in b.rows]
            return row

        def stream() -> Iterator[dict]:
            conv, rows, chars, edge = None, [], 0, True  # edge: what came before may belong to it
            for batch in batches:
                for c, *row in zip(*(batch[x].to_pylist() for x in ("conv_id", "turn", "role", "text", "fault")), strict=True):
                    if rows and c != conv:
                        yield told(conv, rows, not edge)
                        rows, chars, edge = [], 0, False
                    elif rows and (len(rows) >= block or chars > BLOCK_CHARS):
                        yield told(conv, rows, False)
                        rows, chars, edge = [], 0, True
                    conv = c
                    rows.append(tuple(row))
                    chars += len(row[2])
            if rows:
                yield told(conv, rows, False)

        held, size = [], 0
        for row in stream():
            held.append(row)
            size += sum(len(r["text"]) for r in row["rows"] or ())
            if len(held) >= 1000 or size > 4 * BLOCK_CHARS:
                yield pa.RecordBatch.from_pylist(held, schema)
                held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, schema)

    return run


# ---- blocks of long conversations -----------------------------------------------------

def _joined(table: pa.Table, fan: int) -> pa.Table:
    """Neighbouring blocks, in order, as one."""
    blocks = sorted(table.to_pylist(), key=lambda b: b["rank"])
    steps, paths = [], []
    for b in blocks:
        step: dict = {p: [] for p in range(STATES)}
        by: dict = {}
        for w in b["ways"]:
            step[w["p"]].append((w["q"], w["cost"], w["audit"]))
            by[w["p"], w["audit"]] = w["path"]
        steps.append(step)
        paths.append(by)
    out = {"conv_id": blocks[0]["conv_id"], "rank": blocks[0]["rank"] // fan, "low": None, "high": None, "turns": 0,
           "first": blocks[0]["first"], "last": blocks[-1]["last"]}
    out |= {k: sum(b[k] for b in blocks) for k in ("illegal", "blank", "duplicate", "truncated")}
    out["illegal"] += sum(a["last"] + b["first"] not in PAIRS for a, b in zip(blocks, blocks[1:], strict=False))
    for b in blocks:  # turns ascend, so only the one at the seam can be counted twice
        if b["turns"]:
            out["turns"] += b["turns"] - (b["low"] == out["high"])
            out["low"] = b["low"] if out["low"] is None else out["low"]
            out["high"] = b["high"]
    out["ways"] = _ways(steps, False, paths)
    return pa.Table.from_pylist([out], table.schema)


def _apply_blocks(batches):
    """Blocks with their part of the audit -> their repaired text, NULL if nothing is left."""
    for batch in batches:
        text = []
        for rows, state, audit in zip(batch["rows"].to_pylist(), batch["state"].to_pylist(), batch["audit"].to_pylist(), strict=True):
            done = apply([(r["role"], r["text"]) for r in rows], audit, state)
            text.append("\n".join(done) if done else None)
        yield pa.RecordBatch.from_arrays([batch["conv_id"], batch["rank"], pa.array(text, pa.string())], ["conv_id", "rank", "text"])


def _hash(conv_kind: pa.DataType):
    """Pieces in order -> the hash of each conversation, one piece in memory at a time."""

    def run(batches):
        conv, sha, any_text, seen = None, hashlib.sha256(), False, False
        schema = pa.schema([("conv_id", conv_kind), ("sha", pa.string())])
        for batch in batches:
            done = []
            for c, text in zip(batch["conv_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if seen and c != conv:
                    done.append({"conv_id": conv, "sha": sha.hexdigest()})
                    sha, any_text = hashlib.sha256(), False
                conv, seen = c, True
                if text is not None:
                    sha.update(("\n" if any_text else "").encode() + text.encode())
                    any_text = True
            yield pa.RecordBatch.from_pylist(done, schema)
        if seen:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "sha": sha.hexdigest()}], schema)

    return run


def _long(blocks: DataFrame, kind: str, arrow: pa.DataType, fan: int) -> DataFrame:
    """Conversations in several blocks: conv_id, statistics, ways and hash, one row each."""
    spark = blocks.sparkSession
    # one row of a few numbers per block of rows: this window holds no text
    ranks = blocks.select("conv_id", "seq").withColumn("rank", F.row_number().over(W.partitionBy("conv_id").orderBy("seq")) - F.lit(1))
    ranks = ranks.select(F.col("conv_id").alias("_conv"), F.col("seq").alias("_seq"), F.col("rank").cast("long").alias("rank"))
    blocks = cut(blocks.join(ranks, F.col("seq") == F.col("_seq")).drop("_conv", "_seq"), "conversation-blocks")
    level = blocks.drop("rows", "seq", "repaired_sha256")
    schema = f"conv_id {kind}, rank long, {_STATS}, {_WAYS}"
    level = level.select("conv_id", "rank", *[x.split()[0] for x in _STATS.split(", ")], "ways")
    while True:
        level = cut(level.groupBy("conv_id", F.floor(F.col("rank") / fan)).applyInArrow(lambda t: _joined(t, fan), schema), "conversation-level")
        if (level.agg(F.max("rank")).first()[0] or 0) == 0:
            break
    goal = F.array_min(F.transform(F.filter("ways", lambda w: (w.p == 0) & w.q.isin(*GOALS)),
                                   lambda w: F.struct(w.cost.alias("cost"), w.audit.alias("audit"), w.path.alias("path"))))
    whole = cut(level.withColumn("goal", goal).drop("ways", "rank"), "conversation-goals")
    spans = F.expr("transform(goal.path, (x, i) -> named_struct('state', x.state, 'size', x.size, 'at', "
                   "aggregate(slice(goal.path, 1, i), 0L, (s, y) -> s + y.size)))")
    slices = whole.select(F.col("conv_id").alias("_conv"), F.col("goal.audit").alias("_audit"), F.posexplode(spans).alias("_rank", "x"))
    slices = slices.select("_conv", "_rank", F.col("x.state").alias("state"), F.expr("substring(_audit, int(x.at + 1), int(x.size))").alias("audit"))
    meet = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("rank") == F.col("_rank"))
    pieces = blocks.join(slices, meet).select("conv_id", "rank", "rows", "state", "audit").mapInArrow(_apply_blocks, f"conv_id {kind}, rank long, text string")
    hashes = (pieces.repartition(slots(spark), "conv_id").sortWithinPartitions("conv_id", "rank")
              .mapInArrow(_hash(arrow), f"conv_id {kind}, sha string").withColumnRenamed("conv_id", "_conv"))
    return (whole.join(hashes, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
            .select("conv_id", *[x.split()[0] for x in _STATS.split(", ")], F.col("goal.cost").alias("cost"), F.col("goal.audit").alias("audit"),
                    F.col("sha").alias("repaired_sha256")))


def repair(rows: DataFrame, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256.

    Conversations of more than ``block`` rows are taken apart and joined ``fan`` blocks at a time.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = rows.sparkSession
    field = rows.schema["conv_id"].dataType
    kind, arrow = field.simpleString(), to_arrow_type(field)
    rows = with_faults(rows.withColumn("turn", F.col("turn").cast("long")))
    order = ["conv_id", "turn", "role", "digest", "id"]
    ordered = rows.repartitionByRange(slots(spark), *order).sortWithinPartitions(*order)
    schema = f"conv_id {kind}, seq long, rows array<struct<role: string, text: string>>, {_STATS}, {_WAYS}, repaired_sha256 string"
    blocks = cut(ordered.select("conv_id", "turn", "role", "text", "fault").mapInArrow(_blocks(arrow, block), schema), "conversations")
    stats = [x.split()[0] for x in _STATS.split(", ")]
    whole = blocks.filter("repaired_sha256 IS NOT NULL").select(
        "conv_id", *stats, F.col("ways")[0]["cost"].alias("cost"), F.col("ways")[0]["audit"].alias("audit"), "repaired_sha256")
    out = whole.unionByName(_long(blocks.filter("repaired_sha256 IS NULL"), kind, arrow, fan))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    return out.select("conv_id", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op13_repair(conversations: DataFrame, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """Every conversation of the table, damaged by the rule and repaired."""
    done = repair(damaged(conversations), block, fan).withColumnRenamed("conv_id", "_conv")
    every = conversations.select("conv_id").distinct()
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(done, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
