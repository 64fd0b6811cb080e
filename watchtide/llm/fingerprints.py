"""Document fingerprints: SimHash with weighted terms, searched by permuted block tables.

Terms are pairs of adjacent words (and the last word alone), weighted by their number of
characters; each term's 64-bit hash votes with its weight on every bit. Fingerprints
within the chosen radius are found by tables that each leave out as many blocks of the
fingerprint as may differ: two fingerprints within the radius agree on all blocks of one
table at least. All of it is built-in functions.

Defined cases: a NULL or blank text has fingerprint zero; NULL ids come last in the order
of documents, rows with equal ids are ordered by their text; the next document after the
last is the first, so a single document is its own next; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from watchtide.llm.common import cut, slots, word_array

BITS = 64
_LANES = 0x0000000100000001  # a bit and the bit 32 places above are counted in one sum


def text_fingerprints(texts: DataFrame, key: list[str]) -> DataFrame:
    """key columns and ``fp`` (signed long) for a table with ``key`` (unique rows) and ``words`` (array).

    Sums are made per task before anything moves, so that what moves is one row of
    counters per document and not its terms.
    """
    t = texts.select(*key, F.explode_outer(F.arrays_zip(F.col("words").alias("a"), F.expr(
        "if(size(words) > 1, slice(words, 2, size(words) - 1), array())").alias("b"))).alias("t"))
    t = t.select(*key, F.xxhash64("t.a", "t.b").alias("h"),
                 F.coalesce(F.char_length("t.a") + F.coalesce(F.char_length("t.b"), F.lit(0)), F.lit(0)).cast("long").alias("w"))
    sums = t.groupBy(*key).agg(F.sum("w").alias("all"), *[
        F.sum(F.shiftrightunsigned("h", b).bitwiseAND(F.lit(_LANES)) * F.col("w")).alias(f"s{b}") for b in range(32)])
    bits = F.lit(0).cast("long")
    for b in range(32):
        low, high = F.col(f"s{b}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"s{b}", 32)
        bits = bits.bitwiseOR(F.when(2 * low > F.col("all"), F.lit(1 << b)).otherwise(F.lit(0)).cast("long"))
        top = (1 << (b + 32)) if b < 31 else -(1 << 63)
        bits = bits.bitwiseOR(F.when(2 * high > F.col("all"), F.lit(top)).otherwise(F.lit(0)).cast("long"))
    return sums.select(*key, bits.alias("fp"))


def _below(bounds: list[int], value: Column) -> Column:
    """How many of the sorted bounds are smaller: first among every k-th one, then among those between."""
    if not bounds:
        return F.lit(0)
    k = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i:i + k] for i in range(0, len(bounds), k)]
    group = F.size(F.filter(F.array(*[F.lit(g[0]) for g in groups[1:]]).cast("array<bigint>"), lambda b: b < value))
    inner = F.element_at(F.array(*[F.array(*[F.lit(b).cast("long") for b in g]) for g in groups]), group + 1)
    return group * k + F.size(F.filter(inner, lambda b: b < value))


def in_id_order(docs: DataFrame, parts: int) -> DataFrame:
    """doc_id, text in ranges of ascending id, each with the first row of the range after it as guest.

    Adds ``_range`` and ``_guest``: ordered by (_guest, doc_id, text), every row of a range
    that is no guest stands before its next row; the last range's guest is the first row
    of all. The driver holds ``parts`` bounds and one id for each.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    marks = rows.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], max(10_000, 20 * parts))).first()[0]
    bounds = sorted(set(marks or []))
    place = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(_below(bounds, F.col("doc_id")))
    rows = rows.withColumn("_range", place.cast("int"))
    firsts = sorted((r[0], r[1]) for r in rows.groupBy("_range").agg(F.min("doc_id")).collect())
    hosts = [(r, i, firsts[n - 1][0]) for n, (r, i) in enumerate(firsts)]
    hosts = docs.sparkSession.createDataFrame(hosts, "_r int, _first long, _host int")  # a row for each range
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("g"))
    guest = F.struct(F.col("_host").alias("r"), F.lit(True).alias("g"))
    places = F.when(F.col("doc_id").eqNullSafe(F.col("_first")), F.array(own, guest)).otherwise(F.array(own))
    return (rows.join(F.broadcast(hosts), F.col("_range") == F.col("_r"))
            .select("doc_id", "text", F.explode(places).alias("_p"))
            .select("doc_id", "text", F.col("_p.r").alias("_range"), F.col("_p.g").alias("_guest")))


def edited_texts(docs: DataFrame, parts: int) -> DataFrame:
    """Every document with its number in its range, its code points and its edited text.

    The edited text replaces the last floor(n/2) code points by as many of the next document.
    """
    order = W.partitionBy("_range").orderBy("_guest", F.col("doc_id").asc_nulls_last(), "text")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    return (in_id_order(docs, parts)
            .withColumn("_n", F.row_number().over(order)).withColumn("_next", F.lead("text").over(order))
            .withColumn("n_chars", n.cast("long"))
            .withColumn("edited", F.when(~F.col("_guest"), F.concat(
                F.substr("text", F.lit(1), n - half), F.substr(F.coalesce("_next", F.lit("")), F.lit(1), half)))))


def block_keys(fps: DataFrame, radius: int, blocks: int) -> DataFrame:
    """fp, table, key: each table keeps all blocks but ``radius`` of them."""
    edge = [BITS * i // blocks for i in range(blocks + 1)]
    keys = []
    for t, out in enumerate(combinations(range(blocks), radius)):
        m = sum(((1 << (edge[b + 1] - edge[b])) - 1) << edge[b] for b in range(blocks) if b not in out)
        keys.append(F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")))
    return fps.select("fp", "least", F.explode(F.array(*keys)).alias("_k")).select("fp", "least", "_k.table", "_k.key")


def _signed(m: int) -> int:
    return m - (1 << 64) if m >> 63 else m


def nearest_ids(fps: DataFrame, radius: int = 2, blocks: int = 5, family: int = 32) -> DataFrame:
    """fp, near_id: the smallest ``least`` among all fingerprints within the radius, its own included.

    ``fps``: distinct fp with ``least``. Rows that share a table's key are compared in
    pairs unless more than ``family`` do. Those meet under their one-bit variants instead:
    two fingerprints share a variant if and only if they are at most two bits apart.
    """
    if radius != 2:
        raise ValueError("nearest_ids: families of near copies are compared for a radius of 2")
    keys = block_keys(fps, radius, blocks)
    shared = keys.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = cut(shared.select(F.col("table").alias("_t"), F.col("key").alias("_k"), "n"), "block-shared")
    met = cut(keys.join(shared, (F.col("table") == F.col("_t")) & (F.col("key") == F.col("_k"))), "block-met")
    few = met.where(F.col("n") <= family).select("fp", "least", "table", "key")
    other = few.select(F.col("fp").alias("fp2"), F.col("least").alias("least2"), F.col("table").alias("_t"), F.col("key").alias("_k"))
    on = (F.col("table") == F.col("_t")) & (F.col("key") == F.col("_k")) & (F.col("fp") != F.col("fp2"))
    pairs = (few.join(other, on)
             .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= radius)
             .select("fp", F.col("least2").alias("near_id")))
    flips = [F.col("fp").bitwiseXOR(F.lit(_signed(1 << b))) for b in range(BITS)]
    many = met.where(F.col("n") > family).select("fp", "least").distinct()
    variants = many.select("fp", "least", F.explode(F.array(F.col("fp"), *flips)).alias("variant"))
    best = variants.groupBy("variant").agg(F.min("least").alias("near_id"))
    stars = variants.join(best.withColumnRenamed("variant", "_v"), F.col("variant") == F.col("_v")).select("fp", "near_id")
    own = fps.select("fp", F.col("least").alias("near_id"))
    return own.unionByName(pairs).unionByName(stars).groupBy("fp").agg(F.min("near_id").alias("near_id"))


def _hex(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _likeness(a: str, b: str) -> Column:
    return 1 - F.bit_count(F.col(a).bitwiseXOR(F.col(b))) / BITS


def op6_fingerprints(docs: DataFrame, radius: int = 2) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and
    near_id: the smallest id among documents whose fingerprint is within ``radius`` bits."""
    rows = edited_texts(docs, 4 * slots(docs.sparkSession)).withColumn("edited_sha256", F.sha2("edited", 256))
    key = ["_range", "_n", "_guest", "doc_id", "n_chars", "edited_sha256", "_kind"]
    texts = (rows.select(*key[:-1], F.posexplode(F.array("text", "edited")).alias("_kind", "_text"))
             .where("_text IS NOT NULL").select(*key, word_array(F.col("_text")).alias("words")))
    fps = text_fingerprints(texts, key)
    both = fps.groupBy(*key[:-1]).agg(F.max(F.when(F.col("_kind") == 0, F.col("fp"))).alias("fp"),
                                      F.max(F.when(F.col("_kind") == 1, F.col("fp"))).alias("edited_fp"))
    both = both.withColumn("next_fp", F.lead("fp").over(W.partitionBy("_range").orderBy("_n"))).where(~F.col("_guest"))
    both = cut(both.select("doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp"), "fingerprints")
    near = cut(nearest_ids(both.groupBy("fp").agg(F.min("doc_id").alias("least")), radius).withColumnRenamed("fp", "_fp"), "near-ids")
    # Very many documents may share a fingerprint: with two plain tables adaptive execution splits their side.
    return both.join(near, F.col("fp") == F.col("_fp")).select(
        "doc_id", "n_chars", "edited_sha256", _hex("fp").alias("fingerprint"), _hex("edited_fp").alias("edited_fingerprint"),
        _likeness("fp", "edited_fp").alias("near_edited"), _likeness("fp", "next_fp").alias("near_next"), "near_id")
