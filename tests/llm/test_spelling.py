"""Spelling variants against brute force: all deletions of all words, compared by hash."""

import re
from collections import Counter, defaultdict
from zlib import crc32

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF001
from watchtide.llm import spelling
from watchtide.llm.registry import queries


def counted(docs):
    n = Counter()
    for i, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            if len(w) >= 6:
                n[w] += 1
    return {w: c for w, c in n.items() if c >= 5}


def near(words):
    by = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            by[w[:k], w[k + 1:]].add(w)
    out = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            out[w] |= by[w[:k], w[k + 1:]] - {w}
            x = w[:k] + w[k + 1:]
            if x in words:
                out[w].add(x)
                out[x].add(w)
    return out


def expected(words):
    pairs, form = near(words), {}
    for w in words:
        if pairs[w]:
            best = min(pairs[w], key=lambda v: (-words[v], v))
            if words[best] >= 5 * words[w]:
                form[w] = best
    out = {}
    for w, n in words.items():
        r = w
        while r in form:
            r = form[r]
        out[w] = (n, len(pairs[w]), form.get(w), words.get(form.get(w)), r)
    return out


def rows(df):
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}
    assert len(got) == df.count()
    return got


def test_whole_query_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got = rows(queries()["op12_spelling_variants"](spark, SF001))
    want = expected(counted(docs))
    assert got == want and len(want) > 100


def words_of(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


FAMILY = {f"{a}ca{b}in{c}s": 10 + ord(a) + ord(b) + ord(c) for a in "abcd" for b in "bdfklé" for c in "eagÿ"}


def test_groups_that_are_too_large_are_taken_apart_exactly(spark):
    """Words that begin and end alike, with limits that split every group to its end."""
    more = {w + "t": n for w, n in FAMILY.items()} | {w[:-1]: n + 1 for w, n in FAMILY.items()} | {w * 4: 7 for w in list(FAMILY)[:20]}
    words = FAMILY | more
    want = {w: (len(v), min(v, key=lambda x: (-words[x], x))) for w, v in near(words).items() if v}
    for limit in (2, 7, 10_000):
        got = {r.word: (r.n_near, r.near) for r in spelling.near_words(words_of(spark, words), limit).collect()}
        assert got == want


def test_a_family_is_one_root_by_many_steps(spark):
    text = " ".join(["walking"] * 3000 + ["walkin"] * 500 + ["walkinn"] * 60 + ["walkinns"] * 7 + ["Walkinns"] * 1)
    got = rows(spelling.op12_variants(spark.createDataFrame([(3, text)], "doc_id long, text string")))
    assert got == expected(counted([(3, text)]))
    assert {w: got[w][4] for w in got} == {w: "walking" for w in got} and len(got) == 4


def test_defined_cases(spark):
    docs = [(1, None), (2, ""), (None, "lonely words lonely words lonely words lonely words lonely"), (3, "Été " * 9 + "ÉTÉETE " * 6 + "étéété " * 5),
            (4, "twentyfour" * 4000), (4, "repeated " * 5), (4, "repeated " * 5), (5, "×÷×÷×÷ " * 5)]
    df = spark.createDataFrame([(d, t, "w", 9) for d, t in docs], "doc_id long, text string, word string, n int")
    assert rows(spelling.op12_variants(df)) == expected(counted(docs))
    assert spelling.op12_variants(df.limit(0)).collect() == []


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + 1:] == b[k + 1:] or a[k + 1:] == b[k:] or a[k:] == b[k + 1:]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abÿ", min_size=1, max_size=7), min_size=1, max_size=40), st.text("ab", max_size=3))
def test_scan_finds_all_pairs_of_a_list(tails, prefix):
    words = sorted((prefix + t).encode("latin-1") for t in tails)
    got = {(i, j) for i, found in spelling.scan(words, len(prefix)) for j in found.tolist()}
    assert got == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_edit(a, b)}
