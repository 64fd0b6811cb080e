"""Masked pseudo-likelihood: windows, gradients, probabilities, what training gains."""

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF001
from watchtide.llm import masked_lm as M


def net(seed=1):
    n = M.initial(seed)
    rng = np.random.default_rng(seed)
    return {k: rng.normal(0, 0.5, v.shape) for k, v in n.items()}


def plain_log_prob(n, word, around):
    h = np.tanh(n["b"] + sum(n["e"][k][around[k]] for k in range(4)))
    c, m = divmod(int(word), M.MEMBERS)
    def lsm(x):
        return x - np.log(np.exp(x).sum())
    return lsm(h @ n["wc"] + n["bc"])[c] + lsm(h @ n["wm"][c] + n["bm"][c])[m]


def test_windows_see_both_sides_and_end_with_the_text():
    word, around, doc = M.masked_windows(pa.array(["a b c d", None, "e", "f g"]))
    p = M.PAD
    a, b, c, d, e, f, g = word
    assert list(doc) == [0, 0, 0, 0, 2, 3, 3]
    assert around.T.tolist() == [[p, p, b, c], [p, a, c, d], [a, b, d, p], [b, c, p, p], [p] * 4, [p, p, g, p], [p, f, p, p]]


def test_log_probs_against_loops_and_sum_to_one():
    rng = np.random.default_rng(0)
    word, around = rng.integers(0, M.VOCABULARY, 50), rng.integers(0, M.VOCABULARY + 1, (4, 50))
    n = net()
    assert np.allclose(M.log_probs(n, word, around), [plain_log_prob(n, w, a) for w, a in zip(word, around.T)])
    everything = np.arange(M.VOCABULARY)
    assert np.exp(M.log_probs(n, everything, np.repeat(around[:, :1], M.VOCABULARY, axis=1))).sum() == pytest.approx(1)


def test_step_follows_the_gradient():
    rng = np.random.default_rng(3)
    word, around = rng.integers(0, M.VOCABULARY, 30), rng.integers(0, M.VOCABULARY + 1, (4, 30))
    start = net()
    seen = {k: np.zeros(v.shape) for k, v in start.items()}
    moved = {k: v.copy() for k, v in start.items()}
    M.train_step(moved, seen, word, around, rate=1.0)
    for k in start:  # after one step ``seen`` holds the squared gradient
        flat = np.abs(np.sqrt(seen[k])).ravel()
        for i in np.argsort(-flat)[:3]:
            at = np.unravel_index(i, start[k].shape)
            losses = []
            for eps in (1e-4, -1e-4):
                n = {x: v.copy() for x, v in start.items()}
                n[k][at] += eps
                losses.append(-M.log_probs(n, word, around).mean())
            slope = (losses[0] - losses[1]) / 2e-4
            assert abs(slope) == pytest.approx(flat[i], rel=1e-3) and np.sign(moved[k][at] - start[k][at]) == -np.sign(slope)


def test_flat_and_back():
    n = M.initial(4)
    again = M.unflat(M.flat(n))
    assert all((n[k] == again[k]).all() for k in n)


def test_training_beats_word_frequencies_on_held_out_text(spark):
    docs = spark.read.parquet(f"{SF001.replace('0.001', '0.01')}/documents.parquet").repartition(2, "doc_id")
    trained = M.train(docs.where("doc_id % 5 > 0"))
    texts = lambda cond: pa.array([r.text for r in docs.where(cond).collect()])
    seen, _, _ = M.masked_windows(texts("doc_id % 5 > 0"))
    word, around, _ = M.masked_windows(texts("doc_id % 5 = 0"))
    p = (np.bincount(seen, minlength=M.VOCABULARY) + 1) / (len(seen) + M.VOCABULARY)
    assert M.log_probs(trained, word, around).mean() > np.log(p[word]).mean() > -np.log(M.VOCABULARY)


def test_scores_are_sums_and_do_not_depend_on_batches(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    n = M.train(docs)
    got = {r.doc_id: (r.n_words, r.log_likelihood) for r in M.score(docs.repartition(3), n).collect()}
    for r in docs.limit(20).collect():
        word, around, _ = M.masked_windows(pa.array([r.text]))
        assert got[r.doc_id] == (len(word), pytest.approx(M.log_probs(n, word, around).sum(), abs=0.05))


def test_defined_cases(spark):
    rows = [(1, "a b"), (1, "a b"), (2, None), (3, " "), (None, "c"), (5, "long " * 100_000)]
    got = M.op2_pseudo_likelihood(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_words int")).collect()
    assert sorted((r.doc_id or 0, r.n_words) for r in got) == [(0, 1), (1, 2), (1, 2), (2, 0), (3, 0), (5, 100_000)]
    assert all((r.log_likelihood == 0 and r.per_word is None) if not r.n_words else r.log_likelihood < 0 for r in got)
    assert M.op2_pseudo_likelihood(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_every_word_has_a_probability_and_the_vocabulary_grows(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(words[:i + 1] if i % 2 else rng.choice(words[:50], 40)) for i in range(0, 3000, 99)] + [" ".join(words)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    vocab, shares = M.vocabulary(docs)
    h, _ = M.hashed_words(pa.array([" ".join(words)]))
    place, shared = vocab.places(h)
    share = {r.h: r.log_share for r in shares.collect()}
    assert set(share) == set(h[shared].view(np.int64)) and len(set(place[~shared])) == vocab.own == (~shared).sum()
    n = M.train(docs, vocab=vocab)
    lp = M.log_probs(n, place, np.full((4, len(place)), vocab.size)) + [share.get(x, 0.0) for x in h.view(np.int64).tolist()]
    free = sorted(set(range(vocab.size)) - set(place))  # shared places that no word fell into
    rest = np.exp(M.log_probs(n, np.array(free, int), np.full((4, len(free)), vocab.size))).sum()
    assert np.exp(lp).sum() + rest == pytest.approx(1, abs=1e-4)
    got = {r.doc_id: r for r in M.op2_pseudo_likelihood(docs).collect()}
    for i in (0, 7, len(texts) - 1):
        h, _ = M.hashed_words(pa.array([texts[i]]))
        word, around, _ = M.masked_windows(pa.array([texts[i]]), vocab)
        want = M.log_probs(n, word, around).sum() + sum(share.get(x, 0.0) for x in h.view(np.int64).tolist())
        assert got[i].log_likelihood == pytest.approx(want, abs=0.05)
    more = spark.createDataFrame([(1, " ".join(f"x{i}" for i in range(200_000)))], "doc_id long, text string")
    assert M.vocabulary(more)[0].size > vocab.size >= M.VOCABULARY


def test_steps_over_a_text_are_those_over_its_windows(monkeypatch):
    """Gradients of neighbours, summed over the shifted text, equal those summed over the windows."""
    monkeypatch.setattr(M, "BATCH", 37)
    rng = np.random.default_rng(8)
    word, doc = rng.integers(0, 60, 200), np.sort(rng.integers(0, 9, 200))
    one, two = net(2), net(2)
    seen = [{k: np.full(v.shape, 0.5) for k, v in one.items()} for _ in range(2)]
    M.train_text(one, seen[0], word, doc)
    around = M._around(word, doc, M.PAD)
    for a in range(0, 200, 37):
        M.train_step(two, seen[1], word[a:a + 37], around[:, a:a + 37])
    for k in one:
        assert np.allclose(one[k], two[k], atol=1e-6) and np.allclose(seen[0][k], seen[1][k])


def test_scores_do_not_depend_on_the_layout(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    one, many = (sorted((r.doc_id, r.log_likelihood) for r in M.op2_pseudo_likelihood(d).collect())
                 for d in (docs.coalesce(1), docs.repartition(32, "text")))
    assert [i for i, _ in one] == [i for i, _ in many]
    assert max(abs(a - b) for (_, a), (_, b) in zip(one, many)) < 0.05


def test_rounds_of_trainers_against_a_plain_run(spark):
    """The same documents in the same rounds and trainers, one after the other, in numpy."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = M.placed(docs)
    got = M.flat(M.train_placed(rows, trainer_words=8000))
    held = [(r.key, np.array(r.places)) for r in rows.where("n_words > 0").collect()]
    words = sum(len(p) for _, p in held)
    trainers = -(-words // (M.ROUNDS * 8000))
    assert trainers > 1
    values = np.concatenate([M.flat(M.initial(3)), np.zeros(len(M.flat(M.initial(3))))]).astype(float)
    half = len(values) // 2
    for turn in range(M.ROUNDS):
        ends = []
        for trainer in range(trainers):
            mine = sorted((k, i) for i, (k, _) in enumerate(held) if k % (M.ROUNDS * trainers) % M.ROUNDS == turn and k % (M.ROUNDS * trainers) // M.ROUNDS == trainer)
            if mine:
                n, seen = M.unflat(values[:half]), M.unflat(values[half:] ** 2)
                texts = [held[i][1] for _, i in mine]
                M.train_text(n, seen, np.concatenate(texts), np.repeat(np.arange(len(texts)), [len(t) for t in texts]))
                ends.append(np.concatenate([M.flat(n), np.sqrt(M.flat(seen))]))
        values = np.mean(ends, axis=0)
    assert np.allclose(got, values[:half], atol=1e-4)


def test_counts_held_by_tasks_give_what_the_join_gives(spark, monkeypatch):
    """Few words are left to the join with the table of counts, and scores are the same without any held counts."""
    rng = np.random.default_rng(11)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.2, 300) % 5000) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    left, scores = [], []
    for known in (0, M.KNOWN):
        monkeypatch.setattr(M, "KNOWN", known)
        left.append(sum(len(r.shared) for r in M.placed(docs, M.vocabulary(docs)[0]).collect()))
        scores.append({r.doc_id: r.log_likelihood for r in M.op2_pseudo_likelihood(docs).collect()})
    assert left[1] < left[0] / 4
    assert scores[0].keys() == scores[1].keys() and max(abs(scores[0][i] - v) for i, v in scores[1].items()) < 0.05


def test_great_inputs_neither_overflow_nor_vanish():
    n = {k: (v * 1e3).astype(np.float32) for k, v in net().items()}
    everything = np.arange(M.VOCABULARY)
    lp = M.log_probs(n, everything, np.tile([[1], [2], [3], [4]], M.VOCABULARY))
    assert np.isfinite(lp).all() and np.exp(lp).sum() == pytest.approx(1, abs=1e-3)
