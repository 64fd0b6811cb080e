"""Have I seen this key: Bloom filters per date, from built-in bitmap functions.

A key goes to one block of 32,768 bits of its date, chosen by one hash, and sets
``HASHES`` bits there, chosen by others. A stored filter is a table (date, blocks, block, bits) of
4 KiB rows; rows of the same block are merged by OR, so new keys are appended as rows of their own. A
key whose bits are not all set was never added. One whose bits are may have been: only
those go to an exact comparison, and only with the dates they name.

At ``BITS`` bits a key and four hashes 2 to 3 % of new keys pass for seen; the number of
blocks of a date is fixed when it is first written, so a date that grows a lot later should be
written anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32_768  # of one bitmap of bitmap_construct_agg
HASHES = 4
BITS = 12  # a key


def _block(keys, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), *keys), blocks).cast("int")


def _positions(keys) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i + 1), *keys), F.lit(BLOCK_BITS)) for i in range(HASHES)]


def blocks_of(rows: DataFrame, date_col: str, bits: int = BITS) -> DataFrame:
    """Blocks for each date of ``rows``: enough for ``bits`` a row."""
    n = rows.groupBy(date_col).agg(F.count(F.lit(1)).alias("_n"))
    return n.select(date_col, F.ceil(F.col("_n") * bits / BLOCK_BITS).cast("int").alias("blocks"))


def filter_rows(rows: DataFrame, keys, date_col: str, blocks: DataFrame) -> DataFrame:
    """(date, blocks, block, bits): the bits of all keys, one row per block that has any.

    ``blocks`` holds the number of blocks of each date; dates it lacks are left out. Bits are
    set per task before they are shuffled; ``blocks`` goes to every task (a row per date), lest the keys do.
    """
    b = F.broadcast(blocks).select(F.col(date_col).alias("_date"), "blocks")
    at = (rows.select(date_col, *keys).join(b, F.col(date_col) == F.col("_date"))
          .select(date_col, "blocks", _block(keys, F.col("blocks")).alias("block"), F.explode(F.array(*_positions(keys))).alias("_at")))
    return at.groupBy(date_col, "blocks", "block").agg(F.bitmap_construct_agg("_at").alias("bits"))


def merged(filters: DataFrame, date_col: str) -> DataFrame:
    """One row per block of a stored filter."""
    return filters.groupBy(date_col, "blocks", "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.bit_get(byte, (position % 8).cast("int")) == 1


def maybe_seen(rows: DataFrame, filters: DataFrame, keys, date_col: str, out: str = "maybe_seen") -> DataFrame:
    """Add ``out``: false for rows whose key was surely not added for its date; a date without
    a filter is unknown, so its rows may have been seen. A NULL key was never seen."""
    f = merged(filters, date_col)
    blocks = f.groupBy(date_col).agg(F.max("blocks").alias("_blocks")).select(F.col(date_col).alias("_bd"), "_blocks")
    f = f.select(F.col(date_col).alias("_fd"), F.col("block").alias("_block"), "bits")
    j = rows.join(blocks, F.col(date_col) == F.col("_bd"), "left")
    j = j.join(f, (F.col(date_col) == F.col("_fd")) & (_block(keys, F.col("_blocks")) == F.col("_block")), "left")
    seen = F.lit(True)
    for p in _positions(keys):
        seen = seen & _is_set(F.col("bits"), p)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    flag = known & F.when(F.col("_blocks").isNull(), True).otherwise(F.coalesce(seen, F.lit(False)))
    return j.select(*rows.columns, flag.alias(out))


def insert_unseen(target: DataFrame, source: DataFrame, keys, date_col: str, filters: DataFrame,
                  flagged: DataFrame | None = None) -> DataFrame:
    """What ``merge.insert_new`` gives, for a target whose keys are all in ``filters``.

    ``keys`` without the date. Rows surely not seen pass; the target is read only for
    the dates of those that may be: fetched as a list, one per date. ``flagged`` is what
    :func:`maybe_seen` gives for the source, if it has been stored; else it is computed for each use.
    """
    if flagged is None:
        flagged = maybe_seen(source, filters, keys, date_col)
    maybe = flagged.filter("maybe_seen").drop("maybe_seen")
    days = [r[0] for r in maybe.select(date_col).distinct().collect()]
    held = target.filter(F.col(date_col).isin(days)) if days else target.limit(0)
    new = maybe.join(held.select(*keys, date_col), [*keys, date_col], "left_anti")
    return flagged.filter("NOT maybe_seen").select(*source.columns).unionByName(new.select(*source.columns))
