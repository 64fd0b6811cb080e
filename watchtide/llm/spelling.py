"""Spelling variants: words at one edit, by dynamic programming over a sorted word list.

Two words one edit apart, the shorter of L characters, share their first m = L // 2
characters or their last L - m >= m ones, since one edit touches one of the halves. So words meet
in groups by (m, first m characters), and once more read backwards; a pair that shares its
first m characters is left to the forward groups. A group is a sorted list. It is scanned
once for all of its words together: the three diagonals of the edit matrix that one edit
can reach are kept per depth, rows up to the prefix shared with the word before (the
adjacent LCP) are used again, and a range of words whose shared prefix has no query left
within one edit is jumped over. Every word of a group meets the whole group.

Groups are small, but nothing bounds them: many words may begin alike. One of more than
``limit`` words is taken apart one character further on, until none is left: pairs that also
share character d go to groups of d + 1 characters, and pairs that first differ at d are
equal but for that character, so they meet in groups of what is left when it is deleted
(at most one word per character of the alphabet, and the rest itself).

Of each word only its number of near words and the best of them leave a task; pairs are not
written. Counts of words are summed per task before they are shuffled.

Defined cases: a NULL text has no words; a NULL id counts as an empty one in the hash;
repeated rows count each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchtide.llm.common import cut, slots

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
EVERY = 199  # a run whose hash this divides loses a character
HELD = 200_000  # distinct words a task counts before it hands them on
LIMIT = 20_000  # words of a group that are scanned together


# ---- the words ------------------------------------------------------------------------

def _count_words(batches):
    held: Counter = Counter()

    def out():
        words = [w for w in held if len(w) >= LEAST_LENGTH]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([held[w] for w in words], pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            text = text.as_py()
            if not text:
                continue
            seed = crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for w, n in Counter(RUN.findall(text.translate(LOWER))).items():
                if len(w) < LEAST_LENGTH:
                    continue
                h = crc32(w.encode(), seed)
                if h % EVERY == 0:
                    k = h % len(w)
                    w = w[:k] + w[k + 1:]
                held[w] += n
            if len(held) > HELD:
                yield out()
                held.clear()
    yield out()


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """word, n: the words of all texts, after the rule that takes a character from some."""
    words = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(_count_words, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


# ---- one sorted list ------------------------------------------------------------------

def _lcps(words: list[bytes]) -> list[int]:
    """Length of the prefix that each word shares with the one before it."""
    out = [0]
    for a, b in zip(words, words[1:], strict=False):
        n = min(len(a), len(b))
        k = 0
        while k < n and a[k] == b[k]:
            k += 1
        out.append(k)
    return out


def scan(words: list[bytes], shared: int):
    """Pairs one edit apart in a sorted list of distinct words whose first ``shared`` characters agree.

    Yields (index, indexes of the words near it, ascending).
    """
    size = np.array([len(w) for w in words])
    width = int(size.max()) + 3
    text = np.zeros((len(words), width), np.uint8)  # 0: behind the end, equal to no character
    flat = np.frombuffer(b"".join(words), np.uint8)
    text[np.arange(width) < size[:, None]] = flat
    lcp = _lcps(words)
    # depth -> queries still within one edit, and D(depth, depth - 1 | depth | depth + 1)
    first = (np.arange(len(words)), np.ones(len(words), np.int8), np.zeros(len(words), np.int8), np.ones(len(words), np.int8))
    stack = [first]
    i = 0
    while i < len(words):
        word = words[i]
        del stack[max(0, min(lcp[i], len(word)) - shared) + 1:]
        depth = shared + len(stack) - 1
        while depth < len(word):
            who, a, b, c = stack[-1]
            x = word[depth]
            before = (text[who, depth - 1] != x) if depth else np.ones(len(who), bool)
            a2 = np.minimum(a + before, b + 1)
            b2 = np.minimum(np.minimum(b + (text[who, depth] != x), c + 1), a2 + 1)
            c2 = np.minimum(c + (text[who, depth + 1] != x), b2 + 1)
            near = np.flatnonzero(np.minimum(np.minimum(a2, b2), c2) <= 1)
            depth += 1
            stack.append((who[near], a2[near], b2[near], c2[near]))
            if not len(near):
                break
        who, a, b, c = stack[-1]
        if len(who) == 0:  # nothing that begins like this is near any word
            i = bisect_left(words, word[:depth] + b"\xff" * (width - depth), i + 1)
            continue
        off = size[who] - len(word)
        d = np.where(off == -1, a, np.where(off == 0, b, np.where(off == 1, c, 2)))
        found = who[d == 1]
        if len(found):
            yield i, found
        i += 1


def _near_in_groups(batches):
    """Words in order of their groups -> word, near words found here, the best of them."""
    held: list = []  # of one group: (word as grouped, n)
    mark = None

    def best(group, rows):
        back, m, depth, deleted, _ = group
        rows.sort()
        words = [w for w, _ in rows]
        n = [c for _, c in rows]
        plain = [w[::-1] for w in words] if back else words
        for i, others in scan(words, 0 if deleted else depth):
            u, top, count = words[i], None, 0
            for j in others.tolist():
                v = words[j]
                if min(len(u), len(v)) // 2 != m or back and plain[i][:m] == plain[j][:m]:
                    continue
                if deleted and (u[:depth] != v[:depth] or u[depth:depth + 1] == v[depth:depth + 1]):
                    continue
                count += 1
                if top is None or (-n[j], plain[j]) < top:
                    top = (-n[j], plain[j])
            if count:
                yield plain[i].decode("latin-1"), count, top[1].decode("latin-1"), -top[0]

    def out(rows):
        cols = list(zip(*rows)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64())],
                                          ["word", "n_near", "near", "near_n"])

    found: list = []
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("back", "m", "depth", "deleted", "key", "s", "n")]
        for *group, s, n in zip(*columns):
            group = tuple(group)
            if group != mark:
                if len(held) > 1:
                    found += best(mark, held)
                held, mark = [], group
            held.append((s.encode("latin-1"), n))
            if len(found) > 10_000:
                yield out(found)
                found = []
    if len(held) > 1:
        found += best(mark, held)
    yield out(found)


# ---- all lists ------------------------------------------------------------------------

GROUP = ["back", "m", "depth", "deleted", "key"]


def _grouped(words: DataFrame) -> DataFrame:
    """Every word in the groups of its first and of its last characters."""
    length = F.length("word")
    ms = F.array_distinct(F.array(F.floor(length / 2), F.floor((length - 1) / 2)))
    both = words.select("word", "n", F.explode(ms).alias("m"))
    sides = F.array(F.struct(F.lit(False).alias("back"), F.col("word").alias("s")), F.struct(F.lit(True).alias("back"), F.reverse("word").alias("s")))
    both = both.select("n", F.col("m").cast("int").alias("m"), F.explode(sides).alias("x")).select("n", "m", "x.back", "x.s")
    return both.select("back", "m", F.col("m").alias("depth"), F.lit(False).alias("deleted"), F.expr("left(s, m)").alias("key"), "s", "n")


def _split(rows: DataFrame) -> DataFrame:
    """Words of groups that are too large, in groups one character longer and in groups without that character."""
    cols = ["back", "m"]
    less = F.expr("concat(left(s, depth), substring(s, depth + 2))")
    apart = rows.select(*cols, "depth", F.lit(True).alias("deleted"), F.explode(F.array_distinct(F.array(less, F.col("s")))).alias("key"), "s", "n")
    longer = rows.filter(F.length("s") > F.col("depth")).select(
        *cols, (F.col("depth") + 1).alias("depth"), F.lit(False).alias("deleted"), F.expr("left(s, depth + 1)").alias("key"), "s", "n")
    return apart.unionByName(longer)


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("_size"))


def near_words(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """word, n_near, near (the near word of largest count, then least) and near_n, for words that have one.

    ``words`` holds distinct words of characters up to U+00FF with their counts n.
    """
    spark = words.sparkSession
    rows, done = _grouped(words), []
    while True:
        sizes = cut(_sizes(rows).filter(F.col("_size") > limit), "spelling-large").withColumnsRenamed({c: f"_{c}" for c in GROUP})
        if sizes.isEmpty():
            done.append(rows)
            break
        same = [F.col(c) == F.col(f"_{c}") for c in GROUP]
        small = ~F.col("deleted")  # groups of deleted characters are bounded by the alphabet
        done.append(rows.join(sizes, same, "left_anti"))
        done.append(rows.filter("deleted").join(sizes, same, "left_semi"))
        rows = cut(_split(rows.filter(small).join(sizes, same, "left_semi")), "spelling-split")
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    near = (every.repartition(slots(spark), *GROUP).sortWithinPartitions(*GROUP)
            .mapInArrow(_near_in_groups, "word string, n_near long, near string, near_n long"))
    order = F.struct((-F.col("near_n")).alias("n"), "near")
    return near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min_by("near", order).alias("near"), F.max("near_n").alias("near_n"))


def with_roots(forms: DataFrame) -> DataFrame:
    """Add ``root``: from a word follow ``form`` to the last. A form's count is a multiple of
    its word's, so chains are short and end; each round halves them."""
    links = cut(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("to")), "spelling-links")
    while True:
        step = links.select(F.col("word").alias("_w"), F.col("to").alias("_to"))
        ahead = links.join(step, F.col("to") == F.col("_w"), "left")
        new = cut(ahead.select("word", F.coalesce("_to", "to").alias("to"), F.col("_to").isNotNull().alias("moved")), "spelling-links")
        links = new.select("word", "to")
        if new.filter("moved").isEmpty():
            break
    ends = links.select(F.col("word").alias("_w"), F.col("to").alias("_to"))
    return forms.join(ends, F.col("word") == F.col("_w"), "left").select(*forms.columns, F.coalesce("_to", "word").alias("root"))


def op12_variants(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """word, n, n_near, form, form_n, root for every word of the texts."""
    words = cut(vocabulary(docs), "spelling-words")
    near = near_words(words, limit).withColumnsRenamed({"word": "_w"})
    strong = F.col("near_n") >= RATIO * F.col("n")
    forms = words.join(near, F.col("word") == F.col("_w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("near")).alias("form"), F.when(strong, F.col("near_n")).alias("form_n"))
    return with_roots(cut(forms, "spelling-forms"))
