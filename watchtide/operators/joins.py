"""Join strategies for fact x dimension enrichment, with skew handling.

Operators here start no job. The default leaves the choice to Spark, which
broadcasts a side whose measured size is below its threshold and splits skewed
partitions at run time. ``broadcast`` hints only a side the optimizer itself
sizes below a bound; ``merge`` forces a sort-merge join; ``salted`` spreads keys
over salts taken from a column's hash, which retried tasks draw again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchtide.config import DEFAULT_BROADCAST_BYTES
from watchtide.functions.columns import stable_salt


FILE_EXPANSION = 16  # of columnar files in memory, at most


def plan_bytes(df: DataFrame) -> int:
    """Size of a DataFrame as the optimizer sees it; for a table read from files, the files' size.

    Unknown sizes come out very large, so a bound on this never lets them through.
    """
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it is known to be within the bound in memory, else as it is.

    Dictionary-coded files grow by ten and more when they are read, so the optimizer's size, which
    for them is the files', counts ``FILE_EXPANSION`` times.
    """
    return F.broadcast(df) if plan_bytes(df) * FILE_EXPANSION <= max_bytes else df


def _flag_hot(df: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Add ``_hot``: whether the row's key is among ``hot`` (None: all are)."""
    if hot is None:
        return df.withColumn("_hot", F.lit(True))
    h = hot.select(F.col(key).alias("_hot_key")).withColumn("_hot", F.lit(True))
    return (df.join(h, df[key] == h["_hot_key"], "left")
            .withColumn("_hot", F.coalesce("_hot", F.lit(False))).drop("_hot_key"))


def salted_join(fact: DataFrame, dim: DataFrame, key: str, salt_cols, hot: DataFrame | None = None,
                n: int = 8, how: str = "inner", extra: Column | None = None) -> DataFrame:
    """Equi-join on ``key`` with the ``hot`` keys (default: every key) spread over ``n`` salts.

    Fact rows of a hot key take a salt in [0, n) from ``salt_cols`` and the
    dimension's rows of it are repeated n times; other keys keep salt 0 and one
    copy. Rows without a key match nothing and are spread as well. ``hot`` is a
    DataFrame of keys, as ``distinct.heavy_hitters`` finds them (a sample will do: any
    set gives the same rows), which Spark broadcasts if it is small. ``extra`` is an
    additional condition over the columns of ``fact`` and ``dim``.
    """
    f = _flag_hot(fact, key, hot)
    spread = F.col("_hot") | F.col(key).isNull()
    f = f.withColumn("_salt", F.when(spread, stable_salt(n, *salt_cols)).otherwise(F.lit(0))).drop("_hot")
    d = _flag_hot(dim, key, hot)
    d = d.withColumn("_salt", F.explode(
        F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0))))).drop("_hot")
    # salting exists for shuffle joins: keep it one (a broadcast needs no salt)
    d = d.hint("merge")
    if extra is None:
        return f.join(d, [key, "_salt"], how).drop("_salt")
    fa, da = f.alias("_f"), d.alias("_d")
    cond = (F.col(f"_f.{key}") == F.col(f"_d.{key}")) & (F.col("_f._salt") == F.col("_d._salt")) & extra
    out = fa.join(da, cond, how)
    return out.select("_f.*", *[F.col(f"_d.{c}") for c in dim.columns if c != key]).drop("_salt")


def enrich_current(events: DataFrame, dim: DataFrame, key: str = "title_id",
                   strategy: str = "auto", max_bytes: int = DEFAULT_BROADCAST_BYTES,
                   hot: DataFrame | None = None, n: int = 8, salt_cols=("event_id",)) -> DataFrame:
    """USING equi-join of facts with current dimension rows."""
    if strategy == "merge":
        return events.join(dim.hint("merge"), key)
    if strategy == "broadcast":
        return events.join(broadcast_if_small(dim, max_bytes), key)
    if strategy == "salted":
        return salted_join(events, dim, key, salt_cols, hot, n)
    if strategy == "auto":
        return events.join(dim, key)
    raise ValueError(f"unknown strategy {strategy!r}")


def asof_dim_join(fact: DataFrame, dim: DataFrame, key: str = "title_id",
                  date_col: str = "session_date", dim_cols=("title_sk",),
                  how: str = "left", strategy: str = "auto", salt_cols=None, n: int = 8,
                  hot: DataFrame | None = None,
                  valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Facts joined with the dimension version valid on ``date_col``.

    Version intervals are half-open ``[valid_from, valid_to)`` and the range
    predicate sits in the ON clause, so with ``how='left'`` a fact without a
    version keeps its row with NULL dimension columns. ``salted`` (with
    ``salt_cols``) is for a dimension too large to broadcast under hot keys.
    """
    keep = [key, valid_from, valid_to] + [c for c in dim_cols if c not in (key, valid_from, valid_to)]
    d = dim.select(*[F.col(c).alias(f"_d_{c}") for c in keep])
    named = [F.col(f"_d_{c}").alias(c) for c in dim_cols]
    valid = ((F.col(date_col) >= F.col(f"_d_{valid_from}")) & (F.col(date_col) < F.col(f"_d_{valid_to}")))
    if strategy == "salted":
        d = d.withColumnRenamed(f"_d_{key}", key)
        if key in dim_cols:
            d = d.withColumn(f"_d_{key}", F.col(key))
        out = salted_join(fact, d, key, salt_cols, hot, n, how, valid)
    else:
        d = {"auto": lambda x: x, "merge": lambda x: x.hint("merge"), "broadcast": broadcast_if_small}[strategy](d)
        out = fact.join(d, (fact[key] == d[f"_d_{key}"]) & valid, how)
    return out.select(*fact.columns, *named)


def asof_merged(fact: DataFrame, dim: DataFrame, key: str = "title_id", date_col: str = "session_date",
                dim_cols=("title_sk",), how: str = "left", block_days: int = 32, salts: int = 1, salt_cols=(),
                valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """As-of join by merged order: what ``asof_dim_join`` gives where a key has very many versions.

    Facts and versions of a key are put in one order of dates, and each fact takes the last
    version before it: work is linear, where a join on the key meets every fact with every
    version. Keys are cut into blocks of ``block_days``, so that one key is many tasks; the
    version that is open when a block begins is found among the key's versions and the
    blocks its facts lie in (no fact moves for that) and joins the block as a row. ``salts`` spreads a
    block's facts further, by a hash of ``salt_cols``, and repeats its versions. Versions of a key must
    not overlap; a fact in a gap between them, or without a key or date, has none.
    """
    keep = [c for c in dim_cols if c not in (key, valid_from, valid_to)]
    named = [key, valid_from, valid_to, *keep]
    block = lambda d: F.floor(F.datediff(d, F.lit("1970-01-01").cast("date")) / block_days)
    begins = F.expr(f"date_add(DATE'1970-01-01', CAST(_block * {int(block_days)} AS INT))")
    version = F.struct(*[F.col(c).alias(c) for c in named])

    f = fact.select(F.struct(*[F.col(f"`{c}`") for c in fact.columns]).alias("_fact"), F.col(key).alias("_key"), F.to_date(date_col).alias("_date"))
    f = f.withColumn("_block", block(F.col("_date")))
    findable = F.col("_key").isNotNull() & F.col("_date").isNotNull()
    v = dim.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).alias("_key"), F.col(valid_from).alias("_date"), version.alias("_version"))
    v = v.withColumn("_block", block(F.col("_date")))

    # what is open at the start of each block: versions and one mark per block, in order
    marks = f.filter(findable).select("_key", "_block").distinct().withColumn("_date", begins)
    past = Window.partitionBy("_key").orderBy("_date", F.col("_version").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = marks.unionByName(v.drop("_block"), allowMissingColumns=True)
    opened = both.withColumn("_open", F.last("_version", ignorenulls=True).over(past))
    opened = opened.filter("_version IS NULL AND _open IS NOT NULL").select("_key", "_block", "_date", F.col("_open").alias("_version"))

    spread = lambda d: d.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # a version that begins on the first day of a block meets itself as the open one: either will do
    rows = spread(v.unionByName(opened))
    mine = f.filter(findable).withColumn("_salt", stable_salt(salts, *[F.col(f"_fact.{c}") for c in salt_cols]) if salts > 1 else F.lit(0))
    rows = rows.unionByName(mine, allowMissingColumns=True)
    order = Window.partitionBy("_key", "_block", "_salt").orderBy("_date", F.col("_fact").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    held = rows.withColumn("_held", F.last("_version", ignorenulls=True).over(order)).filter("_fact IS NOT NULL")
    held = held.withColumn("_held", F.when(F.col("_date") < F.col(f"_held.{valid_to}"), F.col("_held"))).select("_fact", "_held")
    if how == "left":
        held = held.unionByName(f.filter(~findable).select("_fact"), allowMissingColumns=True)
    elif how == "inner":
        held = held.filter("_held IS NOT NULL")
    else:
        raise ValueError(f"unknown join {how!r}")
    return held.select("_fact.*", *[F.col(f"_held.{c}").alias(c) for c in dim_cols])
