"""Packing: exact round trip of the ids, the plan against all plans, defined cases."""

from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from watchtide.llm import packing
from watchtide.llm.registry import queries


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def check(pieces, docs, tokenizer, size=2048):
    """Every id of every document in one piece, sequences gapless; returns padding and ids."""
    want = [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in docs]
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append((p["offset"], p["length"]))
    have = []
    for d, ps in by_doc.items():
        at, ids, left = 0, [], sorted(ps, key=lambda p: p["start"])
        while left:  # rows that share an id: each one's pieces follow from their starts
            nxt = next((p for p in left if p["start"] == len(ids)), None)
            if nxt is None or (ids and len(ids) == at):
                have.append((d, ids))
                ids, nxt = [], next(p for p in left if p["start"] == 0)
            at = nxt["doc_tokens"]
            ids = ids + np.frombuffer(bytes(nxt["ids"]), "<u4").tolist()
            assert nxt["length"] == len(nxt["ids"]) // 4 > 0
            left.remove(nxt)
        assert len(ids) == at
        have.append((d, ids))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(have, key=key) == sorted(want, key=key)
    pad = 0
    for spans in by_seq.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert 0 < at <= size
        pad += 0 if at & (at - 1) == 0 else size - at
    return pad, sum(len(i) for _, i in want)


def test_documents_come_back_and_padding_is_little(spark, tokenizer):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    pieces = [r.asDict() for r in packing.pack(docs).collect()]
    pad, n = check(pieces, [tuple(r) for r in docs.collect()], tokenizer)
    assert pad < 0.01 * n


def test_query_gives_the_digests_of_the_pieces(spark):
    from zlib import crc32

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {(r.doc_id, r.start): r for r in queries()["op11_window_packing"](spark, SF001).collect()}
    pieces = packing.pack(docs).collect()
    assert len(got) == len(pieces)
    for p in pieces:
        r = got[p.doc_id, p.start]
        assert (r.length, r.ids_crc32, r.doc_tokens, r.sequence_id, r.offset) == (p.length, crc32(bytes(p.ids)), p.doc_tokens, p.sequence_id, p.offset)


def test_defined_cases(spark, tokenizer):
    long = "word and another word. " * 12000  # many windows, more than a stretch
    docs = [(1, None), (2, ""), (3, " \n\t "), (None, "No id. At all."), (None, "No id. At all."), (4, "é" * 5000), (5, long),
            (5, "the same id"), (6, "special <|endoftext|> text"), (7, "a" * 9000)]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, length int, sequence_id string")
    pieces = [r.asDict() for r in packing.pack(df.repartition(1)).collect()]
    pad, n = check(pieces, docs, tokenizer)
    assert n > packing.STRETCH // 5 and pad < 0.02 * n
    assert packing.pack(df.limit(0)).collect() == []
    assert packing.op11_pack(df).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    with pytest.raises(ValueError):
        packing.pack(df, size=8)


def test_ids_are_those_of_the_library(spark, tokenizer):
    voc = packing.vocabulary(packing.TOKENIZER)
    for (t,) in spark.read.parquet(f"{SF001}/documents.parquet").select("text").filter("text IS NOT NULL").collect():
        assert voc.ids(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    for t in ("", " ", "don't  stop\n\n now", "<|endoftext|>", "日本語 😀", "\u0000 x"):
        assert voc.ids(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def every_plan(at, cost, size):
    """Least cost by trying every earlier place."""
    f = [0] + [None] * (len(at) - 1)
    free = set(packing.powers(size))
    for i in range(1, len(at)):
        f[i] = cost[i] + min(f[j] + (0 if at[i] - at[j] in free else size - (at[i] - at[j])) for j in range(i) if at[i] - at[j] <= size)
    return f[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(0, 20)), min_size=1, max_size=80))
def test_the_plan_is_the_best_of_all(steps):
    size = 512
    at = np.cumsum([0, *(8 * s for s, _ in steps)])
    cost = np.array([0, *(c for _, c in steps)])
    best, cuts = packing.plan(at, cost, size)
    assert best == every_plan(at.tolist(), cost.tolist(), size)
    assert cuts[-1] == at[-1] and all(0 < b - a <= size for a, b in zip([0, *cuts], cuts))
    free, of = set(packing.powers(size)), dict(zip(at.tolist(), cost.tolist()))
    assert best == sum(of[b] + (0 if b - a in free else size - (b - a)) for a, b in zip([0, *cuts], cuts))


def test_windows_begin_at_boundaries(spark):
    """Most windows begin where a sentence or a document does."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    starts = packing.pack(docs).filter("offset = 0 AND start > 0").select("ids", "doc_id", "start")
    voc = packing.vocabulary(packing.TOKENIZER)
    first = [np.frombuffer(bytes(r.ids), "<u4")[0] for r in starts.collect()]
    assert np.mean([voc.spaced[i] for i in first]) > 0.5
    assert packing.pack(docs).agg(F.max("length")).first()[0] <= 2048
