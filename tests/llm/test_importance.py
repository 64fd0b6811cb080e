"""Importance resampling: models, weights, exact selection, held-out accuracy."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from conftest import SF001, SF01
from watchtide.llm import importance as I
from watchtide.llm.registry import queries


def test_batch_features_are_those_of_each_text():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["the", "The", "a%%%", "9", "é", "THE"]) for _ in range(rng.randrange(9))) for _ in range(40)] + [None, "", "end"]
    grams, doc = I.features(pa.array(texts))
    for i, t in enumerate(texts):
        alone, _ = I.features(pa.array([t], pa.string()))
        assert sorted(grams[doc == i]) == sorted(alone)
        n = len((t or "").split())
        assert len(alone) == 2 * n + max(0, n - 1)


def test_counts_and_weights_by_hand(spark):
    texts = ["good text here", "good words here", "bad bad bad", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    raw, good = I.ngram_counts(docs, np.array([0, 1]))
    want = [np.bincount(I.features(pa.array([t], pa.string()))[0], minlength=I.BUCKETS) for t in texts]
    assert (raw == sum(want)).all() and (good == want[0] + want[1]).all()
    ratio = I.log_ratio(raw, good)
    for a, b in ((0, I.BUCKETS // 2), (I.BUCKETS // 2, 3 * I.BUCKETS // 4)):  # both sides are distributions
        p = raw[a:b] * good[a:b].sum() / raw[a:b].sum() + 4
        p /= p.sum()
        assert (np.exp(ratio[a:b]) * p).sum() == pytest.approx(1)
    got = {r.doc_id: r.log_weight for r in I.weights(docs, ratio, 1).collect()}
    assert got == {i: pytest.approx((w * ratio).sum(), abs=1e-5) for i, w in enumerate(want)}
    assert got[0] > 0 > got[2] and got[3] == 0


@pytest.mark.parametrize("fan", [2, 7, 4096])
def test_kth_largest(spark, fan):
    rng = random.Random(fan)
    values = [rng.choice([-(10 ** 14), 5, rng.randrange(-1000, 1000), rng.randrange(10 ** 12)]) for _ in range(200)]
    keys = spark.createDataFrame([(v,) for v in values], "key long")
    order = sorted(values, reverse=True)
    for k in (1, 57, 200):
        assert I.kth_largest(keys, "key", k, fan) == order[k - 1]
    assert I.kth_largest(keys, "key", 0) is None and I.kth_largest(keys, "key", 201) is None


def test_the_sample_is_the_top_k(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    got = I.resample(docs, labels, errors=0.0).collect()
    good, n = I.good_share(labels)
    ratio = I.log_ratio(*I.ngram_counts(docs, I.target_ids(labels)))
    keys = {r.doc_id: r.key / I._SCALE for r in I.weights(docs, ratio, 23).collect()}
    k = math.ceil(len(keys) * good / n)
    assert {r.doc_id: r.gumbel_key for r in got} == dict(sorted(keys.items(), key=lambda x: -x[1])[:k])
    assert all(abs(r.gumbel_key - r.log_weight) < 60 for r in got)  # what the draw adds


def test_held_out_documents_are_told_apart(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    train, test = labels.where("doc_id % 2 = 0"), {r.doc_id: r.quality for r in labels.where("doc_id % 2 = 1").collect()}
    weight = {r.doc_id: r.log_weight for r in I.resample(docs, train, errors=100.0).collect()}
    bad = [weight[i] for i, q in test.items() if q == 0]
    fine = [weight[i] for i, q in test.items() if q == 1]
    right = sum(a > b for a in fine for b in bad) / (len(fine) * len(bad))
    assert right > 0.99
    kept = {r.doc_id for r in I.resample(docs, train, errors=4.0).collect()}
    gone = [q for i, q in test.items() if i not in kept]
    assert gone and not any(gone)


def test_defined_cases(spark):
    schema = "doc_id long, text string, log_weight string"
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    rows = [(1, "fine words", "x"), (1, "fine words", "x"), (2, "%%% %%%", "x"), (None, None, None), (3, "", None), (4, "long " * 50_000, None)]
    got = I.kept_documents(spark.createDataFrame(rows, schema), labels)
    assert got.columns == ["doc_id", "text", "log_weight"] and got.count() > 0
    empty = spark.createDataFrame([], schema)
    assert I.resample(empty, labels).collect() == []
    none = spark.createDataFrame([], labels.schema)
    assert I.resample(spark.createDataFrame(rows, schema), none).count() == 6


@pytest.mark.parametrize("sf, stay", [(SF001, 1), (SF01, 2)])
def test_stage_and_query_drop_labelled_bad_documents_however_few_the_labels(spark, sf, stay):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for got in (corpus_pipeline.quality(spark, docs, sf), queries()["op3_importance_resampling"](spark, sf)):
        kept = {r.doc_id for r in got.collect()}
        assert sum(q == 0 and i in kept for i, q in quality.items()) <= stay
        assert all(i in kept for i, q in quality.items() if q == 1)
        assert len(kept) < docs.count()


def test_rows_without_an_id_draw_for_themselves(spark):
    docs = spark.createDataFrame([(None, f"text {i}") for i in range(500)] + [(2**53 + 1, "x"), (2**53, "y")], "doc_id long, text string")
    w = I.weights(docs, np.zeros(I.BUCKETS), 23).collect()
    assert len({r.key for r in w if r.doc_id is None}) > 490
    raw, good = I.ngram_counts(docs, np.array([2**53 + 1]))
    x, _ = I.features(pa.array(["x"]))
    assert good.sum() == len(x) and raw.sum() > good.sum()
