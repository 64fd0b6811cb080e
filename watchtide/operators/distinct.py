"""Distinct counting (exact, HLL, mergeable sketches) and key-skew reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GROUP = ("title_id", "country_code")


def distinct_users(df: DataFrame, keys=GROUP, user: str = "user_id",
                   method: str = "exact", rsd: float = 0.05) -> DataFrame:
    """Per-group distinct users and event count.

    ``exact`` — count_distinct (partial dedup with the user in the grouping
    key before the shuffle); ``approx`` — HLL ``approx_count_distinct`` with
    relative standard deviation ``rsd``; ``none`` — the additive-only floor.
    """
    keys = list(keys)
    events = F.count(F.lit(1)).alias("events")
    if method == "exact":
        return df.groupBy(*keys).agg(F.count_distinct(user).alias("distinct_users"), events)
    if method == "approx":
        return df.groupBy(*keys).agg(F.approx_count_distinct(user, rsd).alias("distinct_users"),
                                     events)
    if method == "none":
        return df.groupBy(*keys).agg(events)
    raise ValueError(f"unknown method {method!r}")


def distinct_error(df: DataFrame, keys=GROUP, user: str = "user_id",
                   rsd: float = 0.05) -> DataFrame:
    """One row: summed exact and HLL per-group distincts, relative error, and
    whether the error is within 3 rsd.

    The two are separate aggregations: in one, the exact count would put the user
    into the grouping key and with it a sketch beside every user. (As two scalar
    subqueries the optimizer would merge them, so they meet in a union of two rows.)
    """
    exact, approx = (distinct_users(df, keys, user, m, rsd).agg(F.sum("distinct_users").alias(m))
                     for m in ("exact", "approx"))
    both = exact.unionByName(approx, allowMissingColumns=True).agg(F.max("exact").alias("exact"), F.max("approx").alias("approx"))
    rel = F.try_divide(F.abs(F.col("approx") - F.col("exact")).cast("double"), F.col("exact"))
    return both.select("exact", "approx", rel.alias("rel_err"),
                       (F.coalesce(rel, F.lit(0.0)) <= F.lit(3 * rsd)).alias("within_bound"))


def distinct_sketch(df: DataFrame, keys, user: str = "user_id", lg_k: int = 12) -> DataFrame:
    """Persistable HLL sketch per group (``hll_sketch_agg``)."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(user, lg_k).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys) -> DataFrame:
    """Re-aggregate sketches to coarser ``keys`` and estimate the distinct count."""
    return (sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))
            .withColumn("estimate", F.hll_sketch_estimate("sketch")))


def _cells(key: str, depth: int, width: int, seed: int):
    """One cell per row of a count-min table of ``depth`` rows and ``width`` columns."""
    return [F.pmod(F.xxhash64(F.lit(seed + i), key), F.lit(width)) for i in range(depth)]


def count_min(df: DataFrame, key: str, width: int = 4096, depth: int = 4, seed: int = 7) -> DataFrame:
    """Count-min table: (row, cell, n), at most ``depth * width`` rows whatever the number of keys.

    A key's smallest count over its cells is never below its true count, and exceeds it
    by more than e * rows / width with a chance of at most e ** -depth.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("row"), c.alias("cell")) for i, c in enumerate(_cells(key, depth, width, seed))])
    return (df.select(F.explode(cells).alias("c")).groupBy("c.row", "c.cell")
            .agg(F.count(F.lit(1)).alias("n")))


def heavy_hitters(df: DataFrame, key: str, threshold: int | None = None, share: float | None = None,
                  method: str = "exact", fraction: float = 0.1, seed: int = 7,
                  width: int = 4096, depth: int = 4) -> DataFrame:
    """Keys with more than ``threshold`` rows, or more than ``share`` of all rows, with counts.

    ``exact`` — partial counts before the shuffle, so a hot key costs one row per map
    task; the total for ``share`` is summed from the same counts. ``sample`` — counts of a
    Bernoulli sample, scaled: estimates, for a first look. ``count_min`` — rows whose key
    cannot be heavy by a count-min table are left out before the exact count, so that
    cold keys, however many, cost no shuffle; the result is exact.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    if method == "sample":
        counts = (df.sample(False, fraction, seed).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
                  .withColumn("n", F.round(F.col("n") / F.lit(fraction)).cast("long")))
    elif method == "count_min":
        table = count_min(df, key, width, depth, seed)
        bar = F.lit(threshold) if share is None else F.lit(share) * table.filter("row = 0").agg(F.sum("n")).scalar()
        maybe = df
        for i, cell in enumerate(_cells(key, depth, width, seed)):
            hot = table.filter((F.col("row") == i) & (F.col("n") > bar)).select(F.col("cell").alias("_cell"))
            # depth * width rows at most: a broadcast of a fixed bound
            maybe = maybe.join(F.broadcast(hot), cell == F.col("_cell"), "left_semi")
        counts = maybe.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        return counts.filter(F.col("n") > bar)
    elif method != "exact":
        raise ValueError(f"unknown method {method!r}")
    return counts.filter(F.col("n") > (F.lit(threshold) if share is None else
                                       F.lit(share) * counts.agg(F.sum("n")).scalar()))


def top_keys(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent keys (ties by key); a TakeOrderedAndProject."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col(key).asc_nulls_first()).limit(k))


def key_skew(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and their ratio to the mean rows per key."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    mean = counts.select(F.avg("n")).scalar()
    return counts.withColumn("ratio_to_mean", F.col("n") / mean)


# ---- exact counts that can be summed up again ------------------------------------------

def dense_ids(values: DataFrame, col: str, known: DataFrame | None = None, parts: int = 4096) -> DataFrame:
    """(value, id): a dictionary of a column's distinct values, ids from 0 without gaps.

    Values are counted by hash bucket, and a bucket's ids begin where the smaller buckets' end, so no
    task numbers more than one bucket. ``known`` is an earlier dictionary: its ids stay, and new values
    go on from its greatest. NULL has no id.
    """
    v = values.filter(F.col(col).isNotNull()).select(F.col(col).alias("value")).distinct()
    start = F.lit(0)
    if known is not None:
        v = v.join(known.select("value"), "value", "left_anti")
        start = F.coalesce(known.agg(F.max("id") + 1).scalar(), F.lit(0))
    v = v.withColumn("_part", F.pmod(F.xxhash64("value"), F.lit(parts)))
    sizes = v.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # parts rows at most, whatever the number of values
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    at = F.row_number().over(Window.partitionBy("_part").orderBy("value")) - 1
    new = (v.withColumn("_at", at).join(sizes, F.col("_part") == F.col("_p"))
           .select("value", (start + F.col("_base") + F.col("_at")).cast("long").alias("id")))
    return new if known is None else known.select("value", "id").unionByName(new)


def distinct_bitmaps(df: DataFrame, keys, user: str = "user_id", ids: DataFrame | None = None) -> DataFrame:
    """(keys, bucket, bits, events): the users of each group as bitmaps, one per 32,768 ids, and its rows.

    ``ids`` is the dictionary of ``user``; without it the column holds dense ids itself. Bits are
    set per task before the shuffle. The group's rows are counted in its bitmaps and once more
    in a row without one, for users without an id.
    """
    rows = df
    if ids is not None:
        rows = df.join(ids.select(F.col("value").alias("_value"), F.col("id").alias("_id")), F.col(user) == F.col("_value"), "left")
    i = F.col("_id") if ids is not None else F.col(user)
    return rows.groupBy(*keys, F.bitmap_bucket_number(i).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(i)).alias("bits"), F.count(F.lit(1)).alias("events"))


def merge_bitmaps(bitmaps: DataFrame, keys) -> DataFrame:
    """Bitmaps of coarser ``keys``: exact again, unlike merged HLL sketches in their error."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("events").alias("events"))


def count_bitmaps(bitmaps: DataFrame, keys) -> DataFrame:
    """Distinct users and events per group from its bitmaps."""
    users = F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits")).otherwise(0)
    return bitmaps.groupBy(*keys).agg(F.sum(users).alias("distinct_users"), F.sum("events").alias("events"))


# ---- frequent keys in one pass -----------------------------------------------------------

def frequent_sketch(df: DataFrame, key: str, keys=(), items: int = 1000) -> DataFrame:
    """A mergeable sketch of the most frequent keys per group, in one pass: at most ``items`` counters each."""
    return df.groupBy(*keys).agg(F.expr(f"approx_top_k_accumulate({key}, {int(items)})").alias("sketch"))


def frequent_keys(sketches: DataFrame, key: str, k: int = 100, items: int = 1000) -> DataFrame:
    """(key, n): the ``k`` most frequent keys of all sketches together, estimated.

    No estimate is too large by more than rows / items; ``salted_join`` takes the keys for ``hot``
    (any set of keys gives it the same rows).
    """
    one = sketches.agg(F.expr(f"approx_top_k_combine(sketch, {int(items)})").alias("sketch"))
    return one.select(F.inline(F.expr(f"approx_top_k_estimate(sketch, {int(k)})"))).toDF(key, "n")
