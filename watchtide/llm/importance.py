"""Quality by importance resampling.

Two generative models over hashed n-grams, one of the target text (documents labelled
good) and one of all raw text, give each document a log importance weight: the sum over
its n-grams of log p_target - log p_raw. Adding a Gumbel draw per document and taking the
k largest samples k documents without replacement in proportion to the weights.

N-grams are hashed words and word pairs, and the shapes of words (classes of the bytes,
and whether the word repeats the one before it), so that text the target doesn't have -
runs of one word, symbols, capitals - is told even where its words are new.

Defined cases: NULL and empty texts have weight 0; a NULL id is an id like any other and
gets its own draw; equal ids get equal draws, and rows equal in key at the k-th place are
all kept; without a good label, or without a bad one, every document is kept; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchtide.llm.common import chunks, cut, lower_ascii, mix, packed, span_hashes, text_bytes, word_bounds

BUCKETS = 1 << 16
MAX_TARGET = 20_000  # labelled rows at most from which the target model is made
_SCALE = 1 << 16     # keys are whole multiples of 1 / _SCALE, so that they can be counted exactly


def _classes() -> np.ndarray:
    """Per byte a bit: lower case or beyond ASCII, upper case, digit, mark within text, other."""
    c = np.full(256, 16, np.uint8)
    c[ord("a"):ord("z") + 1] = 1
    c[128:] = 1
    c[ord("A"):ord("Z") + 1] = 2
    c[ord("0"):ord("9") + 1] = 4
    c[[ord(x) for x in ".,;:!?'\"()-"]] = 8
    return c


_CLASS = _classes()


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of the texts, and the index of its text."""
    data, offsets = text_bytes(texts)
    starts, ends, doc = word_bounds(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = span_hashes(lower_ascii(data), starts, ends)
    same = np.zeros(len(h), bool)
    same[1:] = doc[1:] == doc[:-1]
    first = _CLASS[data[starts]].astype(np.uint64)
    # Reduce over [start, end) only: the gaps between words are left out by every second cut.
    cuts = np.empty(2 * len(starts), np.int64)
    cuts[0::2], cuts[1::2] = starts, ends
    if cuts[-1] == len(data):
        cuts = cuts[:-1]
    kinds = np.bitwise_or.reduceat(_CLASS[data], cuts)[0::2].astype(np.uint64)
    before = np.zeros_like(h)
    before[1:] = h[:-1]
    repeats = (same & (h == before)).astype(np.uint64)
    shape = first | (kinds << np.uint64(5)) | (repeats << np.uint64(10))
    pair = mix(before * np.uint64(3) + h)[same]
    grams = np.concatenate([h % np.uint64(BUCKETS // 2), pair % np.uint64(BUCKETS // 4) + np.uint64(BUCKETS // 2),
                            mix(shape + np.uint64(1)) % np.uint64(BUCKETS // 4) + np.uint64(3 * BUCKETS // 4)])
    return grams.astype(np.int64), np.concatenate([doc, doc[same], doc])


def ngram_counts(docs: DataFrame, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over all documents, and over those whose id is in ``targets`` (sorted)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for whole in batches:
            for b in chunks(whole, "text"):
                grams, doc = features(b.column("text"))
                has = b.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
                ids = b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
                raw += np.bincount(grams, minlength=BUCKETS)
                good += np.bincount(grams[(has & np.isin(ids, targets))[doc]], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, raw[some], good[some])], ["b", "raw", "good"])

    sums = (docs.select("doc_id", "text").mapInArrow(count, "b long, raw long, good long")
            .groupBy("b").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")))
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    got = sums.toPandas()  # BUCKETS rows at most
    raw[got["b"]], good[got["b"]] = got["raw"], got["good"]
    return raw, good


def log_ratio(raw: np.ndarray, good: np.ndarray, smooth: float = 4.0) -> np.ndarray:
    """log p_target - log p_raw per bucket; each of the three kinds of n-gram is a model of its own.

    Both models get ``smooth`` more of every n-gram on the target's scale of counts, so that
    n-grams too rare for the labelled text to show weigh next to nothing.
    """
    out = np.zeros(BUCKETS)
    for a, b in ((0, BUCKETS // 2), (BUCKETS // 2, 3 * BUCKETS // 4), (3 * BUCKETS // 4, BUCKETS)):
        if raw[a:b].sum():
            expected = raw[a:b] * (good[a:b].sum() / raw[a:b].sum())
            out[a:b] = np.log(good[a:b] + smooth) - np.log(expected + smooth)
    return out


def weights(rows: DataFrame, ratio: np.ndarray, seed: int) -> DataFrame:
    """Add log_weight and key (log_weight plus the document's Gumbel draw, in units of 1 / _SCALE)
    to rows with doc_id and text."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for b in chunks(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
            grams, doc = features(b.column("text"))
            out.append(np.bincount(doc, ratio[grams], minlength=b.num_rows))
        return pa.array(np.concatenate(out).astype(float))

    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.when(F.col("doc_id").isNull(), F.col("text"))), 11) + 0.5) / float(1 << 53)
    key = F.col("log_weight") - F.log(-F.log(u))
    return rows.withColumn("log_weight", score("text")).withColumn("key", F.round(key * _SCALE).cast("long"))


def kth_largest(keys: DataFrame, col: str, k: int, fan: int = 4096) -> int | None:
    """The k-th largest value of a whole-number column, exactly; None if k is 0 or beyond the rows.

    Counts in ``fan`` equal ranges, then again within the range that holds the k-th value,
    until a range is one number: the driver sees ``fan`` counts at a time.
    """
    low, high, n = keys.agg(F.min(col), F.max(col), F.count(col)).first()
    if k <= 0 or k > n:
        return None
    left = k
    while low < high:
        width = (high - low) // fan + 1
        counts = (keys.where(F.col(col).between(low, high))
                  .groupBy(F.expr(f"({col} - ({low})) div {width}").alias("r")).count().collect())
        for r, c in sorted(((x["r"], x["count"]) for x in counts), reverse=True):
            if left <= c:
                low, high = low + r * width, min(high, low + (r + 1) * width - 1)
                break
            left -= c
    return low


def good_share(labels: DataFrame) -> tuple[int, int]:
    """Labelled good and all labelled rows."""
    good, n = labels.agg(F.sum((F.col("quality") == 1).cast("long")), F.count("quality")).first()
    return good or 0, n or 0


def target_ids(labels: DataFrame, bound: int = MAX_TARGET, seed: int = 5) -> np.ndarray:
    """Ids of good documents, at most ``bound`` of them, by the smallest seeded hashes."""
    rows = (labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
            .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(bound).collect())
    return np.sort(np.array([r[0] for r in rows], np.int64))


def _bar(docs: DataFrame, labels: DataFrame, errors: float, seed: int) -> tuple[np.ndarray, DataFrame, int | None]:
    """The log ratio per bucket, the documents' weights and keys, and the k-th largest key.

    k is all documents times the labels' share of good ones plus ``errors`` standard
    errors of that share. The query and the pipeline's stage take none: more errors keep more
    good documents that chance or the model places low, but with few labels all bad ones as well.
    Without good labels, or without others, the ratio is 0 and there is no bar.
    """
    good, n = good_share(labels)
    ratio = np.zeros(BUCKETS)
    if 0 < good < n:
        ratio = log_ratio(*ngram_counts(docs, target_ids(labels)))
    w = cut(weights(docs.select("doc_id", "text"), ratio, seed).drop("text"), "quality-weights")
    if not 0 < good < n:
        return ratio, w, None
    rows, share = w.count(), good / n
    share += errors * (share * (1 - share) / n) ** 0.5
    return ratio, w, kth_largest(w, "key", min(rows, math.ceil(rows * share)))


def resample(docs: DataFrame, labels: DataFrame, errors: float = 0.0, seed: int = 23) -> DataFrame:
    """The sampled documents: doc_id, log_weight, gumbel_key."""
    _, w, bar = _bar(docs, labels, errors, seed)
    kept = w if bar is None else w.where(F.col("key") >= bar)
    return kept.select("doc_id", F.round("log_weight", 6).alias("log_weight"), (F.col("key") / float(_SCALE)).alias("gumbel_key"))


def kept_documents(docs: DataFrame, labels: DataFrame, errors: float = 0.0, seed: int = 23) -> DataFrame:
    """The documents that the sample holds, with their own columns.

    Rows are held against the k-th key where they are read: weighing them again costs less
    than moving their texts to meet the sample's ids.
    """
    ratio, _, bar = _bar(docs, labels, errors, seed)
    if bar is None:
        return docs
    return weights(packed(docs, "doc_id", "text"), ratio, seed).where(F.col("key") >= bar).select("doc.*")
