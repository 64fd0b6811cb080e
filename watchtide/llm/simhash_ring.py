"""SimHash near-duplicates, candidates pruned by the pigeonring principle.

Fingerprints are cut into segments on a ring. If two fingerprints differ in at most tau
bits of m segments, then from some segment on every chain of l consecutive segments has
at most floor(l * tau / m) differing bits. The first ``lead`` chain lengths allow no
difference, so these segments together are a hash key; longer chains prune what shares a
key; the full Hamming distance decides. Links join documents into components.

A key that very many fingerprints share (a family of near copies) isn't paired: within
it, fingerprints at most two bits apart meet under one of their own one-bit variants,
and two that share a variant are at most two bits apart, so each is linked to the least
fingerprint of every variant. That is linear in the family and finds the same components.

Defined cases: a NULL or empty text has no words and fingerprint zero, and links like any
other; a NULL id takes part in links but a component's id is its smallest id that isn't
NULL; repeated ids are one document's rows and each keeps its own fingerprint; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from watchtide.llm.common import chunks, cut, lower_ascii, packed, text_bytes
from watchtide.llm.components import components

BITS = 64
_BLOCK = 1 << 15  # shingles whose bits are counted at once


def _votes(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, lowest bit first."""
    total = np.zeros(BITS, np.int64)
    for a in range(0, len(h), _BLOCK):
        bits = np.unpackbits(h[a:a + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return total


_WEIGHTS = np.uint64(1) << np.arange(BITS, dtype=np.uint64)


def fingerprint(words: list[bytes], shingle: int = 3) -> int:
    """Majority of the XXH64 (seed 42) of the space-joined shingles, per bit; 0 without words."""
    if not words:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    h = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), np.uint64, len(grams))
    return int(_WEIGHTS[2 * _votes(h) > len(h)].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in chunks(whole, "text"):
                data, offsets = text_bytes(b.column("text"))
                text = lower_ascii(data).tobytes()
                fps = np.array([fingerprint(text[i:j].split(), shingle) for i, j in zip(offsets, offsets[1:], strict=False)], np.uint64)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, fp long"))


def _chain_mask(start: int, length: int, segments: int) -> int:
    width = BITS // segments
    m = 0
    for s in range(start, start + length):
        m |= ((1 << width) - 1) << ((s % segments) * width)
    return m - (1 << 64) if m >> 63 else m


def lead_length(segments: int, tau: int) -> int:
    """Longest chain that may hold no difference: floor(l * tau / segments) = 0."""
    return max(n for n in range(1, segments + 1) if n * tau // segments == 0)


def ring_keys(fps: DataFrame, segments: int, tau: int) -> DataFrame:
    """fp, chain, key: the leading segments of the chain from every place of the ring."""
    lead = lead_length(segments, tau)
    keys = [F.struct(F.lit(s).alias("chain"), F.col("fp").bitwiseAND(_chain_mask(s, lead, segments)).alias("key"))
            for s in range(segments)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("_k")).select("fp", "_k.chain", "_k.key")


def chain_fits(a: Column, b: Column, chain: int, segments: int, tau: int) -> Column:
    """Every longer chain from this place is within its proportional budget."""
    x, ok = a.bitwiseXOR(b), F.lit(True)
    for n in range(lead_length(segments, tau) + 1, segments):
        ok = ok & (F.bit_count(x.bitwiseAND(_chain_mask(chain, n, segments))) <= n * tau // segments)
    return ok


def _variants(fp: Column) -> Column:
    flips = [fp.bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(BITS)]
    return F.array(fp, *flips)


def links(fps: DataFrame, tau: int = 2, segments: int = 8, family: int = 32) -> DataFrame:
    """u, v: links between distinct fingerprints whose components are those of all pairs within ``tau``.

    Keys shared by at most ``family`` fingerprints give every pair that passes; keys with
    more give each member's link to the least fingerprint under each variant (``tau`` = 2;
    other radii have other variants and are refused).
    """
    if tau != 2:
        raise ValueError("links: families of near copies are joined for a radius of 2")
    keys = cut(ring_keys(fps, segments, tau), "ring-keys")
    shared = keys.groupBy("chain", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = cut(shared.select(F.col("chain").alias("_c"), F.col("key").alias("_k"), "n"), "ring-shared")
    met = cut(keys.join(shared, (F.col("chain") == F.col("_c")) & (F.col("key") == F.col("_k"))).drop("_c", "_k"), "ring-met")

    few = met.where(F.col("n") <= family)
    other = few.select(F.col("fp").alias("fp2"), F.col("chain").alias("_c"), F.col("key").alias("_k"))
    fits = F.lit(False)
    for c in range(segments):
        fits = F.when(F.col("chain") == c, chain_fits(F.col("fp"), F.col("fp2"), c, segments, tau)).otherwise(fits)
    pairs = (few.join(other, (F.col("chain") == F.col("_c")) & (F.col("key") == F.col("_k")) & (F.col("fp") > F.col("fp2")))
             .where(fits).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= tau)
             .select(F.col("fp").alias("u"), F.col("fp2").alias("v")))

    # A family's key takes no part in grouping: the variants alone say who is within reach.
    many = met.where(F.col("n") > family).select("fp").distinct()
    variants = many.select("fp", F.explode(_variants(F.col("fp"))).alias("variant"))
    least = variants.groupBy("variant").agg(F.min("fp").alias("_least"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    stars = (variants.join(least, "variant").where("fp <> _least")
             .select(F.col("fp").alias("u"), F.col("_least").alias("v")))
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, tau: int = 2, segments: int = 8) -> DataFrame:
    """doc_id, fp, component_id of every document."""
    fps = cut(fingerprints(docs, shingle), "ring-fps")
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "ring-distinct")
    comp = components(links(distinct.select("fp"), tau, segments))
    ids = (distinct.join(comp, distinct["fp"] == comp["node"], "left")
           .select("fp", "least", F.coalesce("component", "fp").alias("_comp")))
    ids = cut(ids, "ring-classes")
    smallest = ids.groupBy("_comp").agg(F.min("least").alias("component_id"))
    named = cut(ids.join(smallest, "_comp").select(F.col("fp").alias("_fp"), "component_id"), "ring-named")
    # Very many documents may share a fingerprint: adaptive execution splits their side.
    return fps.join(named, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")


def op5_near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents without near copies: of each component the one with the smallest id stays.

    Rows that share an id are one document, of which the row with the smallest text stays.
    Rows without an id can't be told apart and stay.
    """
    found = cut(near_duplicates(docs, **options), "ring-found")
    # As a table of known size the ids are broadcast if they are few, and the texts stay where they are.
    gone = cut(found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct(), "ring-gone")
    kept = packed(docs).join(gone, F.col("doc.doc_id") == F.col("gone"), "left_anti")
    twice = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("twice"))
    if twice.isEmpty():
        return kept.select("doc.*")
    same = F.col("doc.doc_id") == F.col("twice")
    first = F.row_number().over(W.partitionBy("doc.doc_id").orderBy("doc.text"))
    again = kept.join(twice, same, "left_semi").withColumn("row", first).where("row = 1").drop("row")
    return kept.join(twice, same, "left_anti").union(again).select("doc.*")
