"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source; all rows are then
ordered by fractional rank, (rank - offset) / rows of the source with a seeded offset
between 0 and 1 per source, and the order is cut into equal pieces. A piece covers the same fraction of every source, so every shard has the
mixture of the whole. Both orders are made of bucket counts and ranks within small
buckets, so that neither a source nor the whole table is ever sorted in one task.

Defined cases: a NULL text counts as empty, a NULL source is a source of its own, NULL
ids are allowed; repeated rows are separate rows (which of two equal rows goes where
makes no difference); an empty table gives no rows; other columns are ignored.
The law is ``rows``: equal texts are not kept together, as that and equal row counts
exclude each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from watchtide.llm.common import cut, packed, prefix_counts

ROWS_PER_BUCKET = 64  # expected; what one window group holds


def _buckets(rows: int) -> int:
    return 1 << max(0, (max(1, rows) // ROWS_PER_BUCKET).bit_length())


def assign_shards(rows: DataFrame, shards: int, seed: int = 17) -> DataFrame:
    """Add shard and slot to a table with doc_id, source, size, text_crc32 and any thin columns.

    Rows equal in these four may differ in the others, which then say who comes first.
    The names ``_h _k _at _rank _n _f _p`` are used inside.
    """
    cols = rows.columns
    tie = [F.col(c) for c in ["size", "text_crc32", *cols] if c not in ("doc_id", "source")]
    h = cut(rows.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", "size", "text_crc32")).withColumn("_row", F.monotonically_increasing_id()), "shard-rows")
    # Rows equal in all of these share a hash. Where they are many, their place in the table spreads them.
    many = cut(h.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > ROWS_PER_BUCKET).select(F.col("_h").alias("_many")), "shard-many")
    spread = F.when(F.col("_many").isNull(), F.col("_h")).otherwise(F.xxhash64(F.lit(seed), "_h", "_row"))
    h = h.join(many, F.col("_h") == F.col("_many"), "left").withColumn("_h", spread).drop("_many", "_row")
    total = h.count()
    buckets = _buckets(total)
    bits = buckets.bit_length() - 1
    k = F.shiftrightunsigned("_h", 64 - bits) if bits else F.lit(0).cast("long")
    h = h.withColumn("_k", k)

    hist = h.groupBy("source", "_k").agg(F.count(F.lit(1)).alias("_c"))
    per_source = hist.groupBy("source").agg(F.sum("_c").alias("_n"))
    at = prefix_counts(hist, ["source"], "_k", "_c", "_at").select(
        F.col("source").alias("_s"), F.col("_k").alias("_sk"), "_at")
    at = at.join(per_source.withColumnRenamed("source", "_ps"), F.col("_s").eqNullSafe(F.col("_ps"))).drop("_ps")
    # Unsigned order of the hash: the bucket is its leading bits, the rest decides within.
    low = F.col("_h").bitwiseAND((1 << 62) - 1) if not bits else F.shiftleft("_h", bits)
    within = W.partitionBy("source", "_k").orderBy(low, "doc_id", *tie)
    # Not 1/2 for every source: many sources of few rows would otherwise share one place.
    offset = (F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1 << 20)) + 0.5) / (1 << 20)
    ranked = (h.withColumn("_rank", F.row_number().over(within))
              .join(at, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_k") == F.col("_sk")))
              .withColumn("_f", (F.col("_at") + F.col("_rank") - offset) / F.col("_n"))
              .drop("_at", "_rank", "_n", "_s", "_sk", "_k")
              .withColumn("_k", F.floor(F.col("_f") * buckets)))
    ranked = cut(ranked, "shard-ranks")

    hist = ranked.groupBy("_k").agg(F.count(F.lit(1)).alias("_c"))
    at = prefix_counts(hist, [], "_k", "_c", "_at").select(F.col("_k").alias("_sk"), "_at")
    order = W.partitionBy("_k").orderBy("_f", F.col("source").asc_nulls_last(), "_h", "doc_id", *tie)
    p = F.col("_at") + F.row_number().over(order) - 1
    return (ranked.join(at, F.col("_k") == F.col("_sk")).withColumn("_p", p)
            .withColumn("shard", F.floor((F.col("_p") * shards) / F.lit(total)).cast("int"))
            .withColumn("slot", (F.col("_p") - F.ceil(F.col("shard") * F.lit(total) / shards)).cast("long"))
            .select(*[F.col(c) for c in cols], "shard", "slot"))


def _thin(docs: DataFrame, *more: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), *more)


def op7_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, source, size, text_crc32, law, shard, slot, grown_shard (NULL: law ``rows``)."""
    return assign_shards(_thin(docs), shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")


def sharded_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """The documents' own columns with ``shard`` and ``slot`` (columns so named are replaced).

    Rows are numbered and written once; shards are assigned to thin rows, and the texts
    move once, to meet their assignment by row number.
    """
    rows = cut(packed(docs.drop("shard", "slot")).withColumn("row", F.monotonically_increasing_id()), "shard-docs")
    thin = _thin(rows.select("doc.doc_id", "doc.source", "doc.text", "row"), "row")
    placed = assign_shards(thin, shards).select(F.col("row").alias("placed"), "shard", "slot")
    return rows.join(placed, F.col("row") == F.col("placed")).select("doc.*", "shard", "slot")
