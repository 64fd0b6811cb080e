"""Weighted SimHash and block tables against plain Python."""

import hashlib
import random
import re

import pytest
import xxhash

from conftest import SF001
from watchtide.llm import fingerprints as P


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    votes, total = [0] * 64, 0
    for a, b in zip(words, [*words[1:], None]):
        h = xxhash.xxh64_intdigest(a.encode(), 42)
        if b is not None:
            h = xxhash.xxh64_intdigest(b.encode(), h)
        w = len(a) + len(b or "")
        total += w
        for i in range(64):
            votes[i] += w * (h >> i & 1)
    return sum(1 << i for i in range(64) if 2 * votes[i] > total)


def plain(rows):
    """Expected rows from (doc_id, text) in order."""
    texts = [t or "" for _, t in rows]
    fps = [plain_fingerprint(t) for t in texts]
    out = []
    for n, (i, _) in enumerate(rows):
        t, nxt = texts[n], texts[(n + 1) % len(texts)]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        e = plain_fingerprint(edited)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f"{fps[n]:016x}", f"{e:016x}",
                    1 - (fps[n] ^ e).bit_count() / 64, 1 - (fps[n] ^ fps[(n + 1) % len(rows)]).bit_count() / 64,
                    min((j for (j, _), f in zip(rows, fps) if j is not None and (f ^ fps[n]).bit_count() <= 2), default=None)))
    return out


def key(t):
    return tuple((x is None, x if x is not None else 0) for x in t)


@pytest.mark.parametrize("parts", [None, 1])
def test_whole_table(spark, parts):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in P.op6_fingerprints(docs).collect())
    assert got == sorted(plain(rows))


def test_defined_cases(spark):
    rows = [(1, "é" * 7 + " b c"), (3, None), (3, "x y"), (5, ""), (9, "a b c d e f g h"), (12, "a b c d e f g h")]
    docs = spark.createDataFrame([(*r, "z") for r in random.Random(1).sample(rows, 6)], "doc_id long, text string, fp string")
    got = sorted((tuple(r) for r in P.op6_fingerprints(docs).collect()), key=key)
    assert got == sorted(plain(rows), key=key)


def test_null_ids_come_last(spark):
    rows = [(2, "one two three"), (7, "four five six seven"), (None, "eight nine ten eleven twelve")]
    got = sorted((tuple(r) for r in P.op6_fingerprints(spark.createDataFrame(rows[::-1], "doc_id long, text string")).collect()), key=key)
    assert got == sorted(plain(rows), key=key)


def test_one_document_is_its_own_next_and_none_is_none(spark):
    got = P.op6_fingerprints(spark.createDataFrame([(4, "abcd efgh")], "doc_id long, text string")).collect()
    assert [tuple(r) for r in got] == plain([(4, "abcd efgh")])
    assert P.op6_fingerprints(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("family", [2, 8, 500])
def test_nearest_ids_against_all_pairs(spark, family):
    rng = random.Random(family)
    fps = {}
    for _ in range(15):
        f = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            fps[f - (1 << 64) if f >> 63 else f] = rng.randrange(1000)
            f ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
    df = spark.createDataFrame(list(fps.items()), "fp long, least long")
    got = {r.fp: r.near_id for r in P.nearest_ids(df, family=family).collect()}
    assert got == {a: min(n for b, n in fps.items() if ((a ^ b) % (1 << 64)).bit_count() <= 2) for a in fps}


def test_bounds_split_like_a_search(spark):
    bounds = sorted(random.Random(3).sample(range(1000), 37))
    df = spark.range(1000)
    got = [r[0] for r in df.select(P._below(bounds, df.id)).collect()]
    assert got == [sum(b < i for b in bounds) for i in range(1000)]
