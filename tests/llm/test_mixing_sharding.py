"""Mixing to target weights, and stratified shards."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from watchtide.llm import mixing as M
from watchtide.llm import sharding as S


def plain_targets(sizes):
    """Targets by repeated sharing: what a capped source leaves goes to the others by weight."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    left, free, out = float(sum(sizes.values())), set(order), {}
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > 3 * sizes[s] + 1e-9}
        if not over:
            out |= {s: share * weight[s] for s in free}
            break
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def corpus(seed, n=600):
    rng = random.Random(seed)
    return [(i, " ".join(["w"] * rng.randrange(0, 30)), rng.choice(["a"] * 8 + ["b", "é", "Z", None])) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_taken_words_meet_the_targets(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = M.op10_mix(docs).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(rows)))
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        assert r.size == len((rows[r.doc_id][1] or "").split()) and r.taken <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    want = plain_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 30
    again = {(r.doc_id, r.taken) for r in M.op10_mix(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}


def test_mixed_documents_repeat_as_planned(spark):
    docs = spark.createDataFrame([(*r, "x") for r in corpus(3, 200)], "doc_id long, text string, source string, size string")
    want = {r.doc_id: r.copies for r in M.op10_mix(docs).collect()}
    got = M.mixed_documents(docs)
    assert got.columns == docs.columns
    assert Counter(r.doc_id for r in got.collect()) == Counter({k: v for k, v in want.items() if v})


def test_mixing_defined_cases(spark):
    schema = "doc_id long, text string, source string"
    assert M.op10_mix(spark.createDataFrame([], schema)).collect() == []
    assert M.mixed_documents(spark.createDataFrame([], schema)).collect() == []
    got = M.op10_mix(spark.createDataFrame([(None, None, None), (1, "", "a"), (2, None, "b")], schema)).collect()
    assert [(r.size, r.taken, r.target) for r in got] == [(0, 0, 0.0)] * 3
    rows = [(1, "a b c", "s")] * 5 + [(None, "d e", None)]
    got = M.op10_mix(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 6 and len({r.doc_id for r in got}) == 2
    # of equal rows as many are taken as come nearest to the target
    assert all(abs(sum(r.taken for r in got if r.source == s) - next(r.target for r in got if r.source == s)) <= 1.5 for s in ("s", None))


def shards_of(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    return by


@pytest.mark.parametrize("n", [1, 7, 8, 1000])
def test_shards_are_even_and_follow_the_mixture(spark, n):
    rng = random.Random(n)
    rows = [(i, f"text {i} é", rng.choice(["hot"] * 5 + ["b", "c", None])) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = S.op7_shards(docs).collect()
    assert sorted(r.doc_id for r in got) == list(range(n))
    by = shards_of(got)
    counts = [len(by.get(s, [])) for s in range(8)]
    assert set(by) <= set(range(8)) and max(counts) - min(counts) <= 1
    total = Counter(s for *_, s in rows)
    for s, members in by.items():
        assert sorted(r.slot for r in members) == list(range(len(members)))
        for src, k in Counter(r.source for r in members).items():
            assert abs(k - total[src] * len(members) / n) <= 2.01 + len(total)  # at most a row at each cut and rounding
    for r in got:
        text = rows[r.doc_id][1].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, zlib.crc32(text), "rows", None)
    assert {(r.doc_id, r.shard, r.slot) for r in S.op7_shards(docs.repartition(5)).collect()} == {(r.doc_id, r.shard, r.slot) for r in got}


def test_many_sources_of_one_row(spark):
    docs = spark.createDataFrame([(i, "t", f"s{i}") for i in range(500)], "doc_id long, text string, source string")
    counts = Counter(r.shard for r in S.op7_shards(docs).collect())
    assert sorted(counts.values()) == [62] * 4 + [63] * 4


def test_sharding_defined_cases(spark):
    schema = "doc_id long, text string, source string, shard string"
    assert S.op7_shards(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, None, None, "x"), (1, "", "a", "x"), (1, "", "a", "x"), (1, "b", "a", "y"), (1, "b", None, "y")]
    docs = spark.createDataFrame(rows, schema)
    got = S.op7_shards(docs).collect()
    assert len(got) == 5 and Counter(r["size"] for r in got) == {1: 3, 2: 2}
    whole = S.sharded_documents(docs)
    assert whole.columns == ["doc_id", "text", "source", "shard", "slot"] and whole.count() == 5
    assert Counter((r.doc_id, r.text, r.source) for r in whole.collect()) == Counter((a, b, c) for a, b, c, _ in rows)
    assert {(r.shard, r.slot) for r in whole.collect()} == {(r.shard, r.slot) for r in got}


def test_repeated_rows_come_near_the_target(spark):
    """A third of a source is one row, without an id, again and again."""
    rows = [(i, "w " * 20, "b") for i in range(2000)] + [(None, "same text of ten words in all for this row ", "a")] * 4000
    rows += [(10_000 + i, "v " * (1 + i % 9), "a") for i in range(8000)] + [(1, "big " * 40_000, "c")]
    out = M.op10_mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)).collect()
    taken, target = Counter(), {}
    for r in out:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert len(out) == len(rows) and all(r.taken <= 3 * r.size for r in out)
    assert abs(taken["a"] - target["a"]) <= 10 and abs(taken["b"] - target["b"]) <= 20


def test_equal_rows_are_spread_over_buckets(spark, monkeypatch):
    rows = [(None, "same", "s")] * 5000 + [(i, f"t{i}", "s") for i in range(10_000)]
    kept = {}
    real = S.cut

    def seen(df, name):
        kept[name] = real(df, name)
        return kept[name]

    monkeypatch.setattr(S, "cut", seen)
    out = S.op7_shards(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(out) == 15_000 and {(r.shard, r.slot) for r in out} == {(s, i) for s in range(8) for i in range(1875)}
    assert kept["shard-ranks"].groupBy("_k").count().agg({"count": "max"}).first()[0] < 4 * S.ROWS_PER_BUCKET
    same = Counter(r.shard for r in out if r.doc_id is None)
    assert max(same.values()) - min(same.values()) < 100
