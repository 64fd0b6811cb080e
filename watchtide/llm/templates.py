"""Benchmark decontamination by template canonicalisation.

Words become literals (letters and digits only, lower case) or typed placeholders:
numbers, units after a number, and names (capitalised words that neither start a sentence
or line nor stand in a heading). Windows of template words are joined by hash between benchmark items and
documents; the matched windows of a document and an item at one offset form a run. In a
run each placeholder's value in the item must go with one value in the document (two values
of the item may go with the same): a question with other numbers and names is then covered as
a whole, while a value that goes with several covers only where the document has it too.
Words equal to the item's are covered whatever the slots around them do. Windows of an item with fewer literals than
placeholders, such as rows of numbers, are looked up word for word instead. A document is contaminated by an item
if the words covered are at least ``min_cover`` of the item's words, and ``MIN_WORDS`` of them or all; ``kind`` is
``exact`` if words equal to the item's cover all that is covered, else ``template``.

Defined cases: NULL and empty texts and items have no words and no windows; items shorter
than a window are matched by windows of their own length, if they have a literal; an item
whose windows are partly word for word is held against the words of its template windows as
well as against all its words; rows
that share a doc_id are one document: its runs count together; rows without one are a
document for each text; repeated items count as one, different texts under one item_id
are items of their own, and so are texts without an item_id unless an item with one has them; an empty table on either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchtide.llm.common import chunks, cut, lower_ascii, mix, packed, span_hashes, text_bytes, word_bounds

WINDOW = 5
MIN_COVER, MIN_WORDS = 0.4, 8  # share of an item, and words of it (or all), that consistent runs must cover
HEADING = 5  # so many capitalised words in a row are a heading and no names
FILTER_BITS = 24  # the documents' windows are first looked up in a bitmap of 2**24 bits, whatever the benchmark's size
UNITS = ("mm cm m km in ft yd mi g kg mg t lb lbs oz ml l cl gal s sec min h hr hrs ms day days week weeks month months "
         "year years second seconds minute minutes hour hours inch inches foot feet yard yards mile miles meter meters metre "
         "metres gram grams pound pounds ounce ounces liter liters litre litres dollar dollars cent cents euro euros usd eur gbp "
         "percent degree degrees c f k mph kmh kph hz khz mhz ghz w kw v kb mb gb tb").split()

_NUM, _UNIT, _NAME = (np.uint64(x) for x in (0x11, 0x22, 0x33))
_EXACT = np.uint64(0xA5A5A5A55A5A5A5A)  # sets the hashes of exact windows apart
_KEEP = np.zeros(256, bool)  # letters, digits and all beyond ASCII; white space still parts words
for _a, _b in (("0", "9"), ("A", "Z"), ("a", "z")):
    _KEEP[ord(_a):ord(_b) + 1] = True
_KEEP[128:] = True
_KEEP[[0x20, *range(0x09, 0x0E)]] = True
_STOP = np.zeros(256, bool)  # after these a capital is no sign of a name
_STOP[[ord(c) for c in ".!?:\n\r"]] = True


def _unit_hashes() -> np.ndarray:
    data, offsets = text_bytes(pa.array([" ".join(UNITS)]))
    starts, ends, _ = word_bounds(data, offsets)
    return np.sort(span_hashes(data, starts, ends))


def _lower(data: np.ndarray) -> np.ndarray:
    """A-Z and the Latin-1 capitals (0xC3 and 0x80 to 0x9E, but for the times sign) in lower case."""
    out = lower_ascii(data)
    wide = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[wide] += np.uint8(0x20)
    return out


def _long_runs(flag: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Where ``flag`` holds for n words of one text in a row."""
    cut_here = np.ones(len(flag), bool)
    cut_here[1:] = (flag[1:] != flag[:-1]) | (doc[1:] != doc[:-1])
    run = np.cumsum(cut_here) - 1
    return flag & (np.bincount(run)[run] >= n)


def template_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: its value (hash of the literal), its template word, and the index of its text."""
    raw, raw_offsets = text_bytes(texts)
    keep = _KEEP[raw]
    data = raw[keep]
    place = np.concatenate(([0], np.cumsum(keep)))
    starts, ends, doc = word_bounds(data, place[raw_offsets])
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = span_hashes(_lower(data), starts, ends)
    lead = data[starts]
    follow = data[np.minimum(starts + 1, len(data) - 1)]
    long = ends - starts > 1
    wide_capital = (lead == 0xC3) & (follow >= 0x80) & (follow <= 0x9E)  # Latin-1 capitals in UTF-8
    after = data[np.minimum(starts + 2, len(data) - 1)]
    small = np.where(wide_capital, (ends - starts > 2) & ((after >= 97) & (after <= 122) | (after >= 128)),
                     long & ((follow >= 97) & (follow <= 122) | (follow >= 128)))
    capital = ((lead >= 65) & (lead <= 90) | wide_capital) & small
    stops = np.cumsum(_STOP[raw])[np.flatnonzero(keep)[starts]]
    opens = np.ones(len(starts), bool)
    opens[1:] = (doc[1:] != doc[:-1]) | (stops[1:] != stops[:-1])
    number = (lead >= 48) & (lead <= 57)
    template = value.copy()
    template[capital & ~opens & ~_long_runs(capital, doc, HEADING)] = _NAME
    after_number = np.zeros(len(starts), bool)
    after_number[1:] = number[:-1] & (doc[1:] == doc[:-1])
    template[after_number & np.isin(value, _unit_hashes())] = _UNIT
    template[number] = _NUM
    return value, template, doc


def windows(template: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, hash and number of literals of every window of n template words within one text."""
    if len(template) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int8)
    m = len(template) - n + 1
    h, literal = np.full(m, n, np.uint64), np.zeros(m, np.int8)
    is_literal = ~np.isin(template, (_NUM, _UNIT, _NAME))
    for j in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + template[j:j + m]
        literal += is_literal[j:j + m]
    at = np.flatnonzero(doc[n - 1:] == doc[:m])
    return at, mix(h[at]), literal[at]


_WINDOWS = "pos long, n int, h long, exact boolean, kinds array<long>, vals array<long>"


def _window_rows(keys: dict[str, pa.Array], texts: pa.Array, lengths: list[int], bitmap: np.ndarray | None, window: int) -> pa.RecordBatch:
    """Windows of all texts (of those the bitmap may hold), with the words they are made of."""
    value, template, doc = template_words(texts)
    first = np.searchsorted(doc, np.arange(len(texts)))
    size = np.diff(np.append(first, len(doc)))
    parts = []
    for n in lengths:
        at, h, literal = windows(template, doc, n)
        for exact in (False, True):
            sel = 2 * literal >= n
            if exact:
                h = windows(value, doc, n)[1] ^ _EXACT
            if bitmap is None:  # an item's own window: whole items below the full length
                sel = (~sel & ((literal > 0) | (n == window))) if exact else sel
                sel &= (size[doc[at]] == n) if n < window else size[doc[at]] >= window
            else:  # what an item has word for word may be told apart from names otherwise here
                bit = h & np.uint64((1 << FILTER_BITS) - 1)
                sel = (sel | exact) & ((bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1)
            parts.append((n, at[sel], h[sel], exact))
    rows = sum(len(p[1]) for p in parts)
    words = np.concatenate([(p[1][:, None] + np.arange(p[0])).ravel() for p in parts]) if rows else np.zeros(0, np.int64)
    lens = np.concatenate([np.full(len(p[1]), p[0]) for p in parts]) if rows else np.zeros(0, np.int64)
    at = np.concatenate([p[1] for p in parts]) if rows else np.zeros(0, np.int64)
    h = np.concatenate([p[2] for p in parts]) if rows else np.zeros(0, np.uint64)
    exact = np.concatenate([np.full(len(p[1]), p[3]) for p in parts]) if rows else np.zeros(0, bool)
    kinds = np.where(np.repeat(exact, lens), value[words], template[words])  # no word of an exact window is a slot
    edges = pa.array(np.concatenate(([0], np.cumsum(lens))).astype(np.int32))
    lists = [pa.ListArray.from_arrays(edges, pa.array(x.view(np.int64))) for x in (kinds, value[words])]
    owner = doc[at]
    return pa.RecordBatch.from_arrays(
        [*(k.take(pa.array(owner)) for k in keys.values()), pa.array(at - first[owner]), pa.array(lens.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(exact), *lists],
        [*keys, "pos", "n", "h", "exact", "kinds", "vals"])


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """id (a number for each item's text), item_id, pos, n, h, exact, kinds, vals of every window, ``_reach``, the item's number of words, and
    ``_near``, the end of its last template window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in chunks(whole, "text"):
                yield _window_rows({"id": b.column("id"), "item_id": b.column("item_id")}, b.column("text"), list(range(1, window + 1)), None, window)

    texts = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    named = texts.where("item_id IS NOT NULL")
    unnamed = texts.where("item_id IS NULL").join(named.select(F.col("text").alias("_text")), F.col("text") == F.col("_text"), "left_anti")
    # Written, so that the numbers stay what they are.
    one = cut(named.unionByName(unnamed).withColumn("id", F.monotonically_increasing_id()), "bench-items")
    w = one.mapInArrow(run, "id long, item_id long, " + _WINDOWS)
    end = F.col("pos") + F.col("n")
    size = w.groupBy("id").agg(F.max(end).alias("_reach"), F.max(F.when(~F.col("exact"), end)).alias("_near"))
    return w.join(size.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id")).drop("_id")


def _bitmap(win: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The filter (2**FILTER_BITS bits at most) and the lengths of window in use."""
    bit = F.col("h").bitwiseAND((1 << FILTER_BITS) - 1)
    words = win.groupBy(F.shiftright(bit, 5).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(31).cast("int"))).alias("m")).toPandas()
    full = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    full[words["w"].to_numpy(np.int64)] = words["m"].to_numpy(np.int64).astype(np.uint32)
    lengths = sorted(r[0] for r in win.select("n").distinct().collect())  # as many as a window has words
    return full.view(np.uint8), lengths


def _own(doc_id: str, text: str) -> Column:
    """What tells documents without an id apart: their text, by its digest."""
    return F.when(F.col(doc_id).isNull(), F.coalesce(F.sha2(text, 256), F.lit(""))).otherwise(F.lit(""))


def contaminated(docs: DataFrame, items: DataFrame, min_cover: float = MIN_COVER, window: int = WINDOW) -> DataFrame:
    """doc_id, item_id, covered, item_words, coverage, kind (``exact``, or ``template`` if some words are covered by a slot that differs)."""
    return _contaminated(docs, items, min_cover, window).drop("own")


def _contaminated(docs: DataFrame, items: DataFrame, min_cover: float = MIN_COVER, window: int = WINDOW) -> DataFrame:
    win = cut(item_windows(items, window), "bench-windows")
    bitmap, lengths = _bitmap(win)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in chunks(whole, "text"):
                yield _window_rows({"id": b.column("doc_id"), "own": b.column("own")}, b.column("text"), lengths, bitmap, window)

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _own("doc_id", "text").alias("own"))
    found = found.mapInArrow(run, "id long, own string, " + _WINDOWS)
    w = win.select(F.col("id").alias("item"), "item_id", F.col("pos").alias("_ipos"), F.col("n").alias("_in"), F.col("h").alias("_ih"),
                   F.col("kinds").alias("_ikinds"), F.col("vals").alias("_ivals"), F.col("exact").alias("_iexact"),
                   F.col("_reach").alias("item_words"), F.col("_near").alias("near_words"))
    # Very many documents may hold one passage: adaptive execution splits their side of this join.
    met = found.join(w, (F.col("h") == F.col("_ih")) & (F.col("n") == F.col("_in")) & (F.col("exact") == F.col("_iexact"))
                     & (F.col("kinds") == F.col("_ikinds")))
    met = cut(met.select(F.col("id").alias("doc_id"), "own", "item", "item_id", "item_words", "near_words", "exact", "_ipos", "n", (F.col("pos") - F.col("_ipos")).alias("delta"),
                         "kinds", F.col("vals").alias("mine"), F.col("_ivals").alias("its")), "bench-met")
    # A pair whose windows do not reach enough of the item's words goes before words are told apart. A set
    # has one place per word of the item at most.
    key = ["doc_id", "own", "item"]
    spans = F.array_sort(F.collect_set(F.struct(F.col("_ipos").alias("a"), (F.col("_ipos") + F.col("n")).alias("z"))))
    hope = met.groupBy(*key).agg(spans.alias("_spans"), F.max(F.least("item_words", F.coalesce("near_words", "item_words"))).alias("_least"))
    start = F.struct(F.lit(0).cast("long").alias("z"), F.lit(0).cast("long").alias("n"))
    reach = F.aggregate("_spans", start, lambda s, x: F.struct(
        F.greatest(s["z"], x["z"]).cast("long").alias("z"), (s["n"] + F.greatest(x["z"] - F.greatest(s["z"], x["a"]), F.lit(0))).cast("long").alias("n")))["n"]
    hope = cut(hope.withColumn("_reach", reach).where((F.col("_reach") >= min_cover * F.col("_least")) & (F.col("_reach") >= F.least("_least", F.lit(MIN_WORDS))))
               .select(*[F.col(c).alias(f"_{c}") for c in key]), "bench-hope")
    same = lambda cols: [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cols]
    met = met.join(hope, same(key), "left_semi")
    at = F.arrays_zip(F.sequence(F.col("_ipos"), F.col("_ipos") + F.col("n") - 1).alias("at"), F.col("kinds").alias("kind"), "mine", "its")
    met = cut(met.select(*key, "item_id", "item_words", "near_words", "exact", "delta", F.explode(at).alias("x"))
              .select(*key, "item_id", "item_words", "near_words", "exact", "delta", "x.*").distinct(), "bench-words")
    slot = F.col("kind").isin(int(_NUM), int(_UNIT), int(_NAME))
    value = [*key, "delta", "its"]
    torn = (met.where(slot).groupBy(*value).agg(F.count_distinct("mine").alias("_values")).where("_values > 1")
            .select(*[F.col(c).alias(f"_{c}") for c in value]))
    equal = F.col("mine") == F.col("its")
    good = met.where(equal).unionByName(met.where(slot & ~equal).join(torn, same(value), "left_anti"))

    def enough(covered: str, of: str) -> Column:
        return (F.col(covered) / F.col(of) >= min_cover) & (F.col(covered) >= F.least(F.col(of), F.lit(MIN_WORDS)))

    pairs = (good.groupBy(*key)
             .agg(F.first("item_id").alias("item_id"), F.first("item_words").alias("item_words"), F.first("near_words").alias("_near"),
                  F.count_distinct("at").alias("covered"), F.count_distinct(F.when(~F.col("exact"), F.col("at"))).alias("_covered"),
                  F.count_distinct(F.when(equal, F.col("at"))).alias("_equal")))
    return (pairs.where(enough("covered", "item_words") | enough("_covered", "_near"))
            .select("doc_id", "own", "item_id", "covered", "item_words", (F.col("covered") / F.col("item_words")).alias("coverage"),
                    F.when(F.col("_equal") == F.col("covered"), "exact").otherwise("template").alias("kind")))


def clean_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that no item contaminates, with their own columns."""
    # As a table of known size the ids are broadcast if they are few, and the texts stay where they are.
    bad = cut(_contaminated(docs, items, **options).select(F.col("doc_id").alias("bad"), "own").distinct(), "bench-bad")
    on = F.col("doc.doc_id").eqNullSafe(F.col("bad")) & (_own("doc.doc_id", "doc.text") == F.col("own"))
    return packed(docs).join(bad, on, "left_anti").select("doc.*")
