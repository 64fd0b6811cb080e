"""Scanning and hashing of texts, prefix sums and connected components, against plain Python."""

import random
import re

import pyarrow as pa
import pytest

from watchtide.llm import common as C
from watchtide.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_words_match_a_regular_expression():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab Z\t\n\x0b\r\x0c.é\xa0\x1c") for _ in range(rng.randrange(40))) for _ in range(300)] + [None, "", " ", "x"]
    data, offsets = C.text_bytes(pa.array(texts))
    starts, ends, doc = C.word_bounds(data, offsets)
    got = [(int(d), data[a:b].tobytes().decode()) for a, b, d in zip(starts, ends, doc)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in WORD.findall(t or "")]


def test_hash_depends_on_the_word_alone():
    h, doc = C.hashed_words(pa.array(["one Two one", None, "two\none three", "o ne"]))
    one, two = h[0], h[1]
    assert list(doc) == [0, 0, 0, 2, 2, 2, 3, 3]
    assert h[2] == one and h[3] == two and h[4] == one and len(set(h.tolist())) == 5


def test_sliced_arrays_are_scanned_alike():
    a = pa.array(["x", "alpha beta", None, "gamma"])
    assert list(C.hashed_words(a.slice(1))[0]) == list(C.hashed_words(pa.array(["alpha beta", None, "gamma"]))[0])


def test_chunks_cover_every_row_once():
    b = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (5, 0, 50, 3, 3)] + [None])], ["text"])
    parts = list(C.chunks(b, "text", 10))
    assert sum(p.num_rows for p in parts) == 6 and len(parts) > 1
    assert list(C.chunks(b.slice(0, 0), "text", 10)) == []


def test_words_in_sql(spark):
    texts = [" a  b\tc ", "", None, "\x0bx\x0c", "one"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(C.word_array(df.t)).collect()] == [WORD.findall(t or "") for t in texts]


def test_prefix_counts(spark):
    rng = random.Random(2)
    rows = [(g, b, rng.randrange(9)) for g in ("x", None) for b in rng.sample(range(500), 60)]
    got = C.prefix_counts(spark.createDataFrame(rows, "g string, b long, n long"), ["g"], "b", "n", "p", fold=16).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.p == sum(n for g, b, n in rows if g == r.g and b < r.b)


def _brute(edges):
    least = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    return least


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(-5, 3), (3, 7)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)],
    [(random.Random(5).randrange(1) + i * 7 % 50, i * 13 % 50) for i in range(45)]])
def test_components(spark, edges):
    got = components(spark.createDataFrame(edges, "u long, v long"))
    want = _brute([e for e in edges if e[0] != e[1]])
    assert {r.node: r.component for r in got.collect()} == want


def test_long_texts_are_hashed_in_blocks_alike(monkeypatch):
    text = pa.array([" ".join("w" * (i % 40 + 1) + str(i) for i in range(500)) + " " + "x" * 300])
    whole, _ = C.hashed_words(text)
    monkeypatch.setattr(C, "_SPAN", 64)
    assert (C.hashed_words(text)[0] == whole).all() and len(set(whole.tolist())) == 501
