"""SimHash near-duplicates against all pairs in plain Python."""

import random
import re

import numpy as np
import pytest
import xxhash

from conftest import SF001
from watchtide.llm import simhash_ring as R
from watchtide.llm.components import components

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps):
    """id -> smallest id reachable, over pairs (id, fingerprint)."""
    least = {i: i for i, _ in fps}
    changed = True
    while changed:
        changed = False
        for i, a in fps:
            for j, b in fps:
                if (a ^ b).bit_count() <= 2 and least[i] != least[j]:
                    least[i] = least[j] = min(least[i], least[j])
                    changed = True
    return least


def test_whole_table_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in R.op5_near_duplicates(docs).collect()}
    want = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    comp = plain_components(want)
    assert got == {i: (f"{f:016x}", comp[i]) for i, f in want}


@pytest.mark.parametrize("family", [2, 6, 1000])
def test_links_find_the_components_of_all_pairs(spark, family):
    rng = random.Random(family)
    fps = set()
    for _ in range(12):  # chains and stars of near fingerprints, and single ones
        f = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 14)):
            fps.add(f)
            f ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
    signed = {f - (1 << 64) if f >> 63 else f for f in fps}
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    comp = {r.node: r.component for r in components(R.links(df, family=family)).collect()}
    want = plain_components([(f, f % (1 << 64)) for f in signed])
    assert {f: comp.get(f, f) for f in signed} == want


def test_chain_budgets():
    assert R.lead_length(8, 2) == 3 and R.lead_length(4, 2) == 1
    assert R._chain_mask(7, 3, 8) % (1 << 64) == 0xFF00_0000_0000_FFFF  # round the ring


def test_every_pair_within_the_radius_passes_some_chain(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(200):
        a = rng.getrandbits(63)
        rows.append((a, a ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63))))
    df = spark.createDataFrame(rows, "a long, b long")
    ok = None
    for c in range(8):
        lead = R._chain_mask(c, R.lead_length(8, 2), 8)
        fits = (df.a.bitwiseAND(lead) == df.b.bitwiseAND(lead)) & R.chain_fits(df.a, df.b, c, 8, 2)
        ok = fits if ok is None else ok | fits
    assert df.where(~ok).count() == 0


def test_defined_cases(spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(1, "Same text here now", "x"), (2, "same TEXT here now", "y"), (3, None, None), (4, "", None), (5, " \n", None),
            (6, long, None), (7, long, None), (None, "same text here now", None), (None, "else", None), (9, "short", None), (9, "short", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = [tuple(r) for r in R.op5_near_duplicates(docs).collect()]
    assert len(got) == len(rows)
    by = {}
    for i, f, c in got:
        by.setdefault(i, []).append((f, c))
    assert by[2][0][1] == 1 and by[3] == by[4] == by[5] == [("0" * 16, 3)] and by[7][0][1] == 6
    assert sorted(by[None], key=str) == sorted([(by[1][0][0], 1), (f"{plain_fingerprint('else'):016x}", None)], key=str)
    kept = R.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 3, 6, 9]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert R.op5_near_duplicates(docs).collect() == [] and R.one_of_each(docs).collect() == []


def test_votes_in_blocks():
    h = np.random.default_rng(0).integers(0, 1 << 63, 70_000).astype(np.uint64)
    assert list(R._votes(h)) == [int((h >> np.uint64(b) & np.uint64(1)).sum()) for b in range(64)]
