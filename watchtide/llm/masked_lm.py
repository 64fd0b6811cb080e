"""LM scoring: masked pseudo-likelihood of a bidirectional window network.

The vocabulary is counted over all documents. The network has classes x members places,
each about twice the fourth root of the number of distinct words (CLASSES and MEMBERS at
least): the most frequent words have places of their own, in order of frequency, and all
others are hashed into the last quarter of the places. The network sees the two words
before and the two after a masked place (one embedding table for each of the four
positions), has one tanh layer, and predicts the masked place as its class and its member
of that class. A word in a shared place has the probability of the place times the word's
share of the place's occurrences, so that the probabilities of all words of the corpus add
up to one. A document's score is the sum of the conditional log-probabilities of all its
words.

Training is data-parallel over the whole corpus and reads every word once. Documents are dealt by
hash to ``ROUNDS`` rounds, and in each to trainers of about ``TRAINER_WORDS`` words (``TRAINERS`` at
most); a trainer starts from the average of the round before, goes through its documents in the order of their hash in
mini-batches (Adagrad, numpy), and the networks, with the squares that Adagrad sums, are
averaged. So the result depends on the documents and not on how they lie in files. Sums are of whole
numbers, so the average doesn't depend on the order of tasks, and a task adds up its trainers first. What is gathered from the corpus
grows with it: the table of word counts, which stays in the shared folder, with the number
of distinct words, and the network and its lists of frequent words with the square root of it. Tasks hold the counts of
up to ``KNOWN`` words for each place of a single word, so only words rarer than those are joined with the table.

Defined cases: NULL and blank texts have no words and score 0 (per word: NULL); NULL ids
are passed on; repeated rows are scored alike; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchtide.llm.common import chunks, cut, hashed_words

CLASSES, MEMBERS = 32, 32  # without a vocabulary, and at least
VOCABULARY = CLASSES * MEMBERS
HIDDEN = 16
WINDOW = (-2, -1, 1, 2)
PAD = VOCABULARY  # stands where the window leaves the text
BATCH = 8192
RATE = 0.1
ROUNDS = 4
TRAINER_WORDS = 1 << 21
TRAINERS = 4096
A_TASK = 4  # trainers that one task runs, at most
_CHUNK = 1 << 16  # words that a trainer takes at once
_FIXED = 1 << 30  # parameters are averaged in multiples of 1 / _FIXED
_BLOCK = 1024  # parameters that move in one row
KNOWN = 16  # words whose counts tasks hold, for each place of a single word

Net = dict[str, np.ndarray]


class Vocabulary(NamedTuple):
    """The places of words: ``common`` (sorted hashes) have those in ``ranks``, others share the rest."""

    common: np.ndarray
    ranks: np.ndarray
    own: int  # places for single words; the shared ones come after them
    classes: int
    members: int
    known: np.ndarray = np.zeros(0, np.uint64)  # sorted hashes of frequent words in shared places
    log_shares: np.ndarray = np.zeros(0)  # of those: the logarithm of the word's share of its place

    @property
    def size(self) -> int:
        return self.classes * self.members

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each word's place, and whether it is a shared one."""
        out = (h % np.uint64(self.size - self.own)).astype(np.int64) + self.own
        shared = np.ones(len(h), bool)
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, h), len(self.common) - 1)
            shared = self.common[at] != h
            out[~shared] = self.ranks[at[~shared]]
        return out, shared

    def shares(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For words in shared places: the logarithm of the share (0 if it isn't known here), and whether it is known."""
        if not len(self.known):
            return np.zeros(len(h)), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        known = self.known[at] == h
        return np.where(known, self.log_shares[at], 0.0), known


def _shapes(classes: int, members: int) -> dict[str, tuple[int, ...]]:
    return {"e": (len(WINDOW), classes * members + 1, HIDDEN), "b": (HIDDEN,), "wc": (HIDDEN, classes), "bc": (classes,),
            "wm": (classes, HIDDEN, members), "bm": (classes, members)}


def initial(seed: int, classes: int = CLASSES, members: int = MEMBERS) -> Net:
    rng = np.random.default_rng(seed)
    return {k: (np.zeros(s) if k in ("b", "bc", "bm") else rng.normal(0, 0.1, s)).astype(np.float32)
            for k, s in _shapes(classes, members).items()}


def flat(net: Net) -> np.ndarray:
    return np.concatenate([net[k].ravel() for k in _shapes(CLASSES, MEMBERS)])


def unflat(values: np.ndarray, classes: int = CLASSES, members: int = MEMBERS) -> Net:
    out, at = {}, 0
    for k, s in _shapes(classes, members).items():
        n = int(np.prod(s))
        out[k] = values[at:at + n].reshape(s).astype(np.float32)
        at += n
    return out


def word_counts(docs: DataFrame) -> DataFrame:
    """h (hash of a lower-cased word), n: how often every word of the corpus occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in chunks(whole, "text"):
                h, n = np.unique(hashed_words(b.column("text"))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    return cut(docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "lm-counts")


def vocabulary(docs: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The places of the corpus' words, and h, log_share of every word in a shared place."""
    counts = word_counts(docs)
    side = max(CLASSES, int(np.ceil(2 * counts.count() ** 0.25)))
    own = side * side - side * side // 4
    top = counts.orderBy(F.col("n").desc(), "h").limit(own).toPandas()["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(top)
    vocab = Vocabulary(top[order], order, own, side, side)
    heavy = F.floor(F.log2("n") * 4)
    levels, least, known = counts.groupBy(heavy.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect(), None, 0
    for level, n in sorted(levels, reverse=True):
        known += n
        if known > KNOWN * own:
            break
        least = level
    frequent = counts.where(heavy >= least if least is not None else F.lit(False)).toPandas().sort_values("h", key=lambda h: h.to_numpy(np.int64).view(np.uint64))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places, shared = vocab.places(b.column("h").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([b.column("h"), b.column("n"), pa.array(places)], ["h", "n", "place"]).filter(pa.array(shared))

    rare = cut(counts.mapInArrow(place, "h long, n long, place long"), "lm-rare")
    totals = rare.groupBy(F.col("place").alias("_p")).agg(F.sum("n").alias("_all"))  # a row for each shared place
    h, n = frequent["h"].to_numpy(np.int64).view(np.uint64), frequent["n"].to_numpy(np.int64)
    places, shared = vocab.places(h)
    per_place = np.ones(vocab.size)
    for place_, n_all in totals.collect():
        per_place[place_] = n_all
    vocab = vocab._replace(known=h[shared], log_shares=np.log(n[shared] / per_place[places[shared]]))
    return vocab, rare.join(totals, F.col("place") == F.col("_p")).select("h", F.log(F.col("n") / F.col("_all")).alias("log_share"))


def _around(word: np.ndarray, doc: np.ndarray, pad: int) -> np.ndarray:
    around = np.full((len(WINDOW), len(word)), pad, np.int64)
    for k, d in enumerate(WINDOW):
        a, b = (slice(-d, None), slice(None, d)) if d < 0 else (slice(None, -d), slice(d, None))
        same = doc[a] == doc[b]
        around[k, a][same] = word[b][same]
    return around


def masked_windows(texts: pa.Array, vocab: Vocabulary | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: its place in the vocabulary, the places around it, and the index of its text."""
    h, doc = hashed_words(texts)
    word = vocab.places(h)[0] if vocab else (h % np.uint64(VOCABULARY)).astype(np.int64)
    return word, _around(word, doc, vocab.size if vocab else PAD), doc


_SMALL = 60  # inputs of a softmax up to here, of either sign, neither overflow nor vanish in float32


def _biased(w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Weights with their bias as one more row, for inputs that end with a one."""
    return np.concatenate([w, b[..., None, :]], axis=-2)


def _is_small(w: np.ndarray) -> bool:
    """Whether inputs between -1 and 1 give small softmax inputs under (biased) weights."""
    return bool(np.abs(w).sum(axis=-2).max() <= _SMALL)


def _exp(x: np.ndarray, small: bool) -> tuple[np.ndarray, np.ndarray | float]:
    """By row: the sum of exponentials on the scale of the greatest (as they are, if ``small``), and the
    logarithm of that scale; ``x`` is overwritten by them."""
    top = 0.0
    if not small:
        top = x.max(axis=1)
        x -= top[:, None]
    np.exp(x, out=x)
    return x @ np.ones(x.shape[1], x.dtype), top


def _log_norm(x: np.ndarray, small: bool) -> np.ndarray:
    total, top = _exp(x, small)
    return np.log(total) + top


def _hidden(net: Net, around: np.ndarray) -> np.ndarray:
    x = net["b"] + net["e"][0].take(around[0], axis=0)
    for k in range(1, len(WINDOW)):
        x += net["e"][k].take(around[k], axis=0)
    return np.tanh(x, out=x)


def _by_class(cls: np.ndarray, classes: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order that brings words together by class, and each class that occurs with its first place and its end there."""
    order = np.argsort(cls.astype(np.min_scalar_type(classes)), kind="stable")  # short numbers are sorted by digits
    ends = np.cumsum(np.bincount(cls, minlength=classes)).tolist()
    return order, [(c, a, b) for c, (a, b) in enumerate(zip([0, *ends], ends)) if b > a]


def _with_one(h: np.ndarray, order: np.ndarray) -> np.ndarray:
    out = np.ones((len(order), h.shape[1] + 1), h.dtype)
    out[:, :-1] = h[order]
    return out


def _member_inputs(h: np.ndarray, wm: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Inputs of the softmax over the members of each word's own class, for words in the order of their classes."""
    x = np.empty((len(h), wm.shape[2]), h.dtype)
    for c, a, b in spans:
        np.matmul(h[a:b], wm[c], out=x[a:b])
    return x


def log_probs(net: Net, word: np.ndarray, around: np.ndarray) -> np.ndarray:
    """log P(word | the words around it) of every word."""
    out = np.empty(len(word))
    classes, _, members = net["wm"].shape
    wc, wm = _biased(net["wc"], net["bc"]), _biased(net["wm"], net["bm"])
    small = _is_small(wc), _is_small(wm)
    for a in range(0, len(word), BATCH):
        cls, member = np.divmod(word[a:a + BATCH], members)
        order, spans = _by_class(cls, classes)
        h = _with_one(_hidden(net, around[:, a:a + BATCH]), order)
        at = np.arange(len(order))
        x = h @ wc
        lp = x[at, cls[order]]
        lp -= _log_norm(x, small[0])
        x = _member_inputs(h, wm, spans)
        lp += x[at, member[order]]
        lp -= _log_norm(x, small[1])
        out[a:a + BATCH][order] = lp
    return out


def _loss_slope(x: np.ndarray, at: np.ndarray, small: bool) -> np.ndarray:
    """Gradient of the mean loss by the inputs of a softmax whose right answers are ``at``; in place of ``x``."""
    n = len(x)
    x *= (1 / (_exp(x, small)[0] * n))[:, None].astype(x.dtype)
    x[np.arange(n), at] -= x.dtype.type(1 / n)
    return x


def _sums_around(around: np.ndarray, dh: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each position: the places that occur there, and the sums of ``dh`` over them."""
    for at in around:
        order = np.argsort(at, kind="stable")
        ids, first = np.unique(at[order], return_index=True)
        yield ids, np.add.reduceat(dh[order], first)


def _sums_in_text(word: np.ndarray, doc: np.ndarray, a: int, b: int, pad: int, dh: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """What :func:`_sums_around` gives for the words a to b of a text: the neighbours are the text
    itself, shifted, so it is sorted once for all positions."""
    reach = max(WINDOW)
    low, high = max(0, a - reach), min(len(word), b + reach)
    part = word[low:high].astype(np.uint16) if pad < 1 << 16 else word[low:high]  # short numbers are sorted by digits
    order = np.argsort(part, kind="stable")
    sorted_part = part[order]
    first = np.flatnonzero(np.concatenate(([True], sorted_part[1:] != sorted_part[:-1])))
    ids = np.append(word[low:high][order[first]], pad)
    for d in WINDOW:
        i = max(a, -d)
        j = max(i, min(b, len(word) - d))  # words i to j have a neighbour d places on
        same = doc[i + d:j + d] == doc[i:j]
        slope = np.zeros((high - low, dh.shape[1]), dh.dtype)  # by neighbour
        np.multiply(dh[i - a:j - a], same[:, None], out=slope[i + d - low:j + d - low])
        alone = np.concatenate([np.arange(min(i, b) - a), np.flatnonzero(~same) + (i - a), np.arange(j - a, b - a)])
        yield ids, np.concatenate([np.add.reduceat(slope.take(order, axis=0), first), dh[alone].sum(axis=0, keepdims=True)])


def train_step(net: Net, seen: Net, word: np.ndarray, around: np.ndarray, rate: float = RATE, sums=_sums_around) -> None:
    """One Adagrad step on the mean loss of a mini-batch; ``net`` and ``seen`` (squares) change.

    ``sums`` adds up the gradients of the places around (:func:`_sums_around`).
    """
    classes, _, members = net["wm"].shape
    wc, wm = _biased(net["wc"], net["bc"]), _biased(net["wm"], net["bm"])
    cls, member = np.divmod(word, members)
    order, spans = _by_class(cls, classes)
    plain = _hidden(net, around)
    h = _with_one(plain, order)
    p = _loss_slope(h @ wc, cls[order], _is_small(wc))
    q = _loss_slope(_member_inputs(h, wm, spans), member[order], _is_small(wm))
    by_wc, by_wm = h.T @ p, np.zeros_like(wm)
    slope, dh = np.empty_like(plain), np.empty_like(plain)
    for c, a, b in spans:
        np.matmul(h[a:b].T, q[a:b], out=by_wm[c])
        np.matmul(q[a:b], net["wm"][c].T, out=slope[a:b])
    slope += p @ net["wc"].T
    dh[order] = slope
    dh *= 1 - plain * plain
    grad = {"wc": by_wc[:-1], "bc": by_wc[-1], "wm": by_wm[:, :-1], "bm": by_wm[:, -1], "b": dh.sum(axis=0)}
    for k, g in grad.items():
        seen[k] += g * g
        net[k] -= (rate * g / (np.sqrt(seen[k]) + 1e-8)).astype(np.float32)
    for k, (ids, g) in enumerate(sums(around, dh)):  # only the places that occur have a gradient
        s = seen["e"][k].take(ids, axis=0) + g * g
        seen["e"][k][ids] = s
        g *= rate
        g /= np.sqrt(s) + 1e-8
        net["e"][k][ids] -= g


def train_text(net: Net, seen: Net, word: np.ndarray, doc: np.ndarray) -> None:
    """Steps over the words of some texts, in their order."""
    pad = net["e"].shape[1] - 1
    around = _around(word, doc, pad)
    for a in range(0, len(word), BATCH):
        b = min(a + BATCH, len(word))
        train_step(net, seen, word[a:b], around[:, a:b], sums=lambda _, dh, a=a, b=b: _sums_in_text(word, doc, a, b, pad, dh))


def placed(docs: DataFrame, vocab: Vocabulary | None = None) -> DataFrame:
    """doc_id, key (hash of id and text), n_words, places (of the words) of every document, and with a
    vocabulary ``row`` (a number of its own), ``within`` (sum of the log shares known to it) and ``shared``: hashes of the
    other words in shared places. Texts are scanned for it once, and it is written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in chunks(whole, "text"):
                h, doc = hashed_words(b.column("text"))
                word, shared = vocab.places(h) if vocab else ((h % np.uint64(VOCABULARY)).astype(np.int64), np.zeros(len(h), bool))
                out = {"doc_id": b.column("doc_id"), "key": b.column("key"), "n_words": pa.array(np.bincount(doc, minlength=b.num_rows)),
                       "places": _lists(word.astype(np.int32), doc, b.num_rows)}
                if vocab:
                    h, doc = h[shared], doc[shared]
                    log_share, known = vocab.shares(h)
                    out["within"] = pa.array(np.bincount(doc, log_share, minlength=b.num_rows).astype(float))
                    out["shared"] = _lists(h[~known].view(np.int64), doc[~known], b.num_rows)
                yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("key"))
    columns = "doc_id long, key long, n_words long, places array<int>"
    if not vocab:
        return cut(docs.mapInArrow(run, columns), "lm-places")
    return cut(docs.mapInArrow(run, f"{columns}, within double, shared array<long>").withColumn("row", F.monotonically_increasing_id()), "lm-places")


def _lists(values: np.ndarray, doc: np.ndarray, docs: int) -> pa.ListArray:
    """The values of each document, which lie one after the other."""
    ends = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=docs)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def train(docs: DataFrame, seed: int = 3, vocab: Vocabulary | None = None) -> Net:
    """The network trained on ``docs`` (doc_id, text)."""
    return train_placed(placed(docs, vocab), seed, vocab)


def train_placed(rows: DataFrame, seed: int = 3, vocab: Vocabulary | None = None, trainer_words: int = TRAINER_WORDS) -> Net:
    """The average of the networks that trainers make of their :func:`placed` documents, round after round."""
    sides = (vocab.classes, vocab.members) if vocab else (CLASSES, MEMBERS)
    state = [flat(initial(seed, *sides)).astype(float), np.zeros(sum(int(np.prod(s)) for s in _shapes(*sides).values()))]
    words = rows.agg(F.sum("n_words")).first()[0] or 0
    trainers = max(1, min(TRAINERS, -(-words // (ROUNDS * trainer_words))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who, net, seen, held, size = None, {}, {}, [], 0
        total, weight = 0, 0  # of the trainers that have ended

        def step() -> None:
            nonlocal held, size
            if held:
                word = np.concatenate(held).astype(np.int64)
                train_text(net, seen, word, np.repeat(np.arange(len(held)), [len(x) for x in held]))
            held, size = [], 0

        def done() -> None:
            nonlocal total, weight
            step()
            values = np.clip(np.concatenate([flat(net), np.sqrt(flat(seen))]).astype(float), -500, 500)
            total, weight = total + np.rint(values * float(_FIXED)).astype(np.int64), weight + 1

        for b in batches:
            for trainer, text in zip(b.column("trainer").to_pylist(), b.column("places"), strict=True):
                if trainer != who:
                    if who is not None:
                        done()
                    who, net, seen = trainer, unflat(state[0], *sides), unflat(state[1] ** 2, *sides)
                held.append(text.values.to_numpy())
                size += len(held[-1])
                if size >= _CHUNK:
                    step()
        if who is not None:
            done()
            yield _blocks({i: total[x:x + _BLOCK] for i, x in enumerate(range(0, len(total), _BLOCK))}, weight)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        weight: dict[int, int] = {}
        for b in batches:
            for i, v, w in zip(b.column("i").to_pylist(), b.column("v"), b.column("weight").to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + v.values.to_numpy()
                weight[i] = weight.get(i, 0) + w
        if sums:
            yield _blocks(sums, next(iter(weight.values())))  # every block stands for all trainers

    columns = "i long, v array<long>, weight long"
    # a task adds up the networks of its trainers before they move
    tasks = max(-(-trainers // A_TASK), min(trainers, rows.sparkSession.sparkContext.defaultParallelism))
    deal = F.pmod("key", F.lit(ROUNDS * trainers))
    rows = rows.where("n_words > 0").select("key", "places", (deal % ROUNDS).alias("round"), F.floor(deal / ROUNDS).alias("trainer"))
    for turn in range(ROUNDS):
        mine = rows.where(F.col("round") == turn).repartitionById(tasks, (F.col("trainer") % tasks).cast("int")).sortWithinPartitions("trainer", "key")
        got = mine.select("trainer", "places").mapInArrow(run, columns).repartition("i").mapInArrow(add, columns).collect()
        both = np.concatenate(state)
        for i, v, weight in got:  # the network's parameters and squares, _BLOCK in a row
            both[i * _BLOCK:i * _BLOCK + len(v)] = np.array(v, float) / weight / _FIXED
        state = [both[:len(state[0])], both[len(state[0]):]]
    return unflat(state[0], *sides)


def _blocks(values: dict[int, np.ndarray], weight: int) -> pa.RecordBatch:
    ends = np.cumsum([0, *(len(v) for v in values.values())]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(list(values.values()))))
    return pa.RecordBatch.from_arrays([pa.array(list(values), pa.int64()), lists, pa.array(np.full(len(values), weight))], ["i", "v", "weight"])


def score(docs: DataFrame, net: Net, vocab: Vocabulary | None = None) -> DataFrame:
    """:func:`score_placed` of documents (doc_id, text)."""
    return score_placed(placed(docs, vocab), net)


def score_placed(rows: DataFrame, net: Net) -> DataFrame:
    """doc_id, n_words, log_likelihood (sum over the words' places) of every :func:`placed` document, and ``row`` and ``within`` if it has them."""
    pad = net["e"].shape[1] - 1
    keep = [c for c in ("doc_id", "n_words", "row", "within") if c in rows.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            n = whole.column("n_words").to_numpy()
            ends = np.concatenate(([0], np.cumsum(n)))
            at = 0
            while at < whole.num_rows:  # so many documents that their words are about a chunk
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + _CHUNK, side="right")) - 1)
                b = whole.slice(at, to - at)
                word = b.column("places").flatten().to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(b.num_rows), n[at:to])
                total = np.bincount(doc, log_probs(net, word, _around(word, doc, pad)), minlength=b.num_rows).astype(float)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(np.round(total, 4))], [*keep, "log_likelihood"])
                at = to

    kinds = {"doc_id": "long", "n_words": "long", "row": "long", "within": "double"}
    return rows.select(*keep, "places").mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", log_likelihood double")


def op2_pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, log_likelihood, per_word."""
    vocab, shares = vocabulary(docs)
    rows = placed(docs, vocab)
    scored = cut(score_placed(rows, train_placed(rows, vocab=vocab)), "lm-scores")
    shares = cut(shares.withColumnRenamed("h", "_h"), "lm-shares")
    rest = (rows.select("row", F.explode("shared").alias("h")).join(shares, F.col("h") == F.col("_h"))
            .groupBy(F.col("row").alias("_r")).agg(F.sum("log_share").alias("_rest")))
    total = F.round(F.col("log_likelihood") + F.col("within") + F.coalesce("_rest", F.lit(0.0)), 4)
    return (scored.join(rest, F.col("row") == F.col("_r"), "left").select("doc_id", "n_words", total.alias("log_likelihood"))
            .withColumn("per_word", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))))
