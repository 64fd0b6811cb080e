"""Packing into fixed windows by order-preserving dynamic programming.

The documents of a partition, in their order, are one stream of token ids; every
document ends in an end id. Windows of at most ``size`` ids are cut from the stream, one
after the other, so that padding plus penalties are least:

    f(i) = penalty(i) + min over j of f(j) + padding(b_i - b_j),  b_i - b_j <= size

over the places b where a cut may lie: document ends (penalty 0), sentence ends inside a
document (``sentence``), and steps of ``STEP`` ids within a sentence longer than that
(``hard``). Padding is size - x for a window of x ids and nothing where x is a power of
two from ``LEAST`` on. For the first form the minimum of f(j) + b_j over a sliding range
is kept in a monotone queue; the powers of two are looked up by place. The stream is
planned in stretches of ``STRETCH`` ids: what a plan says of its last windows is left to
the next stretch, so a task holds one stretch and one text, and only the end of a
partition is not followed by more. There, cuts may lie at every id of the last two windows.

There is no shuffle. Windows do not reach over partitions. Sequence ids are the
partition's number and a count within it, so a task that is run again gives the same rows.

Defined cases: a NULL text counts as empty and is packed as its end id alone; blank texts
are tokenized as they are; a text longer than a window is cut; repeated rows and rows
without an id are packed each on its own; an empty table gives no rows; other columns are
ignored, whatever their names.

Token ids are those of the ``tokenizers`` library for a byte-level BPE file. They are
computed by tiktoken from the same file's vocabulary, four times as fast (texts that
hold the string of a special token go to ``tokenizers`` itself).
"""

from __future__ import annotations

import functools
import json
import os
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k.json"
END_ID = 1
STEP = 32
LEAST = 256
STRETCH = 1 << 18
KEEP = 8  # windows at the end of a stretch that are planned again with what follows


# ---- token ids ------------------------------------------------------------------------

def _byte_of() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: itself where it
    prints, else the next free one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Encoder of a byte-level BPE file, and which of its ids end a sentence or begin with a space."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        self.path = path if os.path.sep in path else public_tokenizers.path(path)
        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError(f"{path} is no byte-level BPE with the usual pattern")
        self.special = [t["content"] for t in spec["added_tokens"]]
        byte = _byte_of()
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.fast = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        top = 1 + max([END_ID, *ranks.values(), *(t["id"] for t in spec["added_tokens"])])
        self.ends, self.spaced = np.zeros(top, bool), np.zeros(top, bool)
        for t, i in ranks.items():
            self.ends[i] = t[-1:] in (b".", b"!", b"?", b"\n")
            self.spaced[i] = t[:1] in (b" ", b"\n", b"\r", b"\t")

    @functools.cached_property
    def whole(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), np.uint32)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


# ---- the plan -------------------------------------------------------------------------

def places(ids: np.ndarray, doc_ends: np.ndarray, voc: Vocabulary, sentence: int, hard: int,
           dense_from: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Where the stream may be cut, and the penalty of each place; 0 and the end are among them.

    From ``dense_from`` on every place is one.
    """
    n = len(ids)
    cost = np.full(n + 1, -1, np.int32)
    after = np.flatnonzero(voc.ends[ids[:-1]] & voc.spaced[ids[1:]]) + 1 if n > 1 else np.zeros(0, int)
    cost[after] = sentence
    cost[doc_ends] = 0
    cost[[0, n]] = 0
    known = np.flatnonzero(cost >= 0)
    for a, gap in zip(known[:-1][np.diff(known) > STEP].tolist(), np.diff(known)[np.diff(known) > STEP].tolist()):
        cost[a + STEP:a + gap:STEP] = hard
    if dense_from is not None:
        tail = cost[dense_from:]
        tail[tail < 0] = hard
    at = np.flatnonzero(cost >= 0)
    return at, cost[at]


def powers(size: int) -> list[int]:
    return [1 << k for k in range(LEAST.bit_length() - 1, size.bit_length()) if 1 << k <= size]


def plan(at: np.ndarray, cost: np.ndarray, size: int) -> tuple[int, list[int]]:
    """Least padding plus penalties from the first place to the last, and the cuts of that plan.

    ``at`` ascends by at most ``size``.
    """
    n = len(at)
    where = np.full(int(at[-1]) + 1, -1, np.int64)
    where[at] = np.arange(n)
    i, j = [], []
    for x in powers(size):
        to = np.flatnonzero(at >= x)
        frm = where[at[to] - x]
        i.append(to[frm >= 0])
        j.append(frm[frm >= 0])
    i, j = np.concatenate(i), np.concatenate(j)
    order = np.argsort(i, kind="stable")
    exact_to, exact_from = [*i[order].tolist(), n], j[order].tolist()
    b, pen = at.tolist(), cost.tolist()
    f, g, back = [0] * n, [0] * n, [0] * n  # g: f + b
    g[0] = b[0]
    queue, e = deque([0]), 0  # places in reach, g ascending: the first is the least
    for k in range(1, n):
        here = b[k]
        while b[queue[0]] < here - size:
            queue.popleft()
        last = queue[0]
        best = g[last] + size - here
        while exact_to[e] == k:
            if f[exact_from[e]] < best:
                last = exact_from[e]
                best = f[last]
            e += 1
        f[k], back[k] = best + pen[k], last
        g[k] = f[k] + here
        while queue and g[queue[-1]] >= g[k]:
            queue.pop()
        queue.append(k)
    cuts, k = [], n - 1
    while k:
        cuts.append(b[k])
        k = back[k]
    return f[-1], [*cuts[::-1]]


class _Stream:
    """The ids of a partition that are not yet cut into windows."""

    def __init__(self, voc: Vocabulary, size: int, sentence: int, hard: int):
        self.voc, self.size, self.sentence, self.hard = voc, size, sentence, hard
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple] = []  # (id, its tokens, where it begins: below 0 if a part of it is gone)
        self.n = 0
        self.windows = 0

    def add(self, doc_id, text: str | None) -> None:
        ids = np.append(self.voc.ids(text or ""), np.uint32(END_ID))
        self.docs.append((doc_id, len(ids), self.n))
        self.parts.append(ids)
        self.n += len(ids)

    def cut(self, last: bool) -> Iterator[tuple]:
        """Pieces of the windows planned for sure; all of them at the end."""
        ids = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint32)
        if not len(ids):
            return
        ends = np.array([at + n for _, n, at in self.docs], np.int64)
        dense = max(0, len(ids) - 2 * self.size) if last else None
        _, cuts = plan(*places(ids, ends, self.voc, self.sentence, self.hard, dense), self.size)
        if not last:
            cuts = cuts[:-KEEP]
        d = a = 0
        for z in cuts:
            p = a
            while p < z:
                doc_id, n, at = self.docs[d]
                q = min(z, at + n)
                yield doc_id, p - at, q - p, ids[p:q].tobytes(), n, self.windows, p - a
                p = q
                d += q == at + n
            a = z
            self.windows += 1
        self.docs = [(i, n, at - a) for i, n, at in self.docs[d:]]
        self.parts = [ids[a:].copy()]
        self.n = len(ids) - a


def pack(docs: DataFrame, size: int = 2048, tokenizer: str = TOKENIZER, sentence: int = 4, hard: int = 16) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit, as binary), doc_tokens, sequence_id, offset.

    One row per piece: ``ids`` are those of the document from ``start`` on, at ``offset`` of
    the sequence. ``tokenizer`` is a path, or the name of one of the public files.
    """
    if size < LEAST or size < STEP:
        raise ValueError(f"windows of fewer than {max(LEAST, STEP)} ids are not planned")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def run(batches):
        stream = _Stream(vocabulary(tokenizer), size, sentence, hard)
        base, types = TaskContext.get().partitionId() << 40, None

        def out(pieces, least):
            rows = list(pieces)
            for k in range(0, len(rows), least):
                doc, start, length, ids, n, window, offset = zip(*rows[k:k + least])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, types), *(pa.array(x, pa.int64()) for x in (start, length)), pa.array(ids, pa.binary()), pa.array(n, pa.int64()),
                     pa.array([base + w for w in window], pa.int64()), pa.array(offset, pa.int64())],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            types = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                stream.add(doc_id, text.as_py())
                if stream.n >= STRETCH:
                    yield from out(stream.cut(False), 1000)
        yield from out(stream.cut(True), 1000)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def op11_pack(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """The pieces with ``ids_crc32`` in place of the ids."""
    return pack(docs, tokenizer=tokenizer).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
