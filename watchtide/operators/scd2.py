"""Slowly changing dimension, type 2.

Rules for applying snapshot ``s`` dated ``snap`` to the current versions:
1. key not current -> insert version ``[snap, 9999-12-31)``;
2. key current with equal ``attr_hash`` -> no change;
3. key current with another hash -> close it (``valid_to = snap``,
   ``is_current = false``) and insert the new version;
4. key current but absent from ``s`` -> untouched (disappearance does not close).
``title_sk = xxhash64(title_id BIGINT, snapshot date string)``.

``scd2_apply`` is the incremental step (one snapshot); ``scd2_rebuild``
derives the same history declaratively from all snapshots at once; ``scd2_splice`` puts
snapshots that come late into the history there is.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from watchtide.config import HIGH_DATE, TITLE_ATTRS
from watchtide.functions.columns import attr_hash
from watchtide.schemas import GOLD_DIM_TITLE

DIM_COLS = [f.name for f in GOLD_DIM_TITLE.fields]
ATTRS = [c for c in TITLE_ATTRS if c != "title_id"]


def with_attr_hash(snapshot: DataFrame) -> DataFrame:
    return snapshot.withColumn("attr_hash", attr_hash(snapshot))


def empty_dim(spark) -> DataFrame:
    return spark.createDataFrame([], GOLD_DIM_TITLE)


def _version(df: DataFrame, snap_col) -> DataFrame:
    """Snapshot rows (with attr_hash) -> opened versions."""
    return df.select(
        F.xxhash64(F.col("title_id").cast("long"), snap_col.cast("string")).alias("title_sk"),
        "attr_hash", F.col("title_id").cast("long").alias("title_id"), *ATTRS,
        F.to_date(snap_col.cast("string")).alias("valid_from"),
        F.lit(dt.date.fromisoformat(HIGH_DATE)).alias("valid_to"),
        F.lit(True).alias("is_current"))


def scd2_apply(dim: DataFrame, snapshot: DataFrame, snap: str) -> DataFrame:
    """Next state of the dimension after applying one snapshot (rules 1–4).

    ``snapshot`` holds one row per title (silver grain). Current versions meet the
    snapshot in one full outer join, and each joined row yields its kept or closed
    old version and/or its new version through a generator. Closed versions pass by
    and never move.
    """
    snap_d = dt.date.fromisoformat(str(snap))
    s = with_attr_hash(snapshot.select(*TITLE_ATTRS))
    s = s.select(*[F.col(c).alias(f"_s_{c}") for c in s.columns])
    now = dim.filter("is_current")
    j = now.join(s, now["title_id"] == s["_s_title_id"].cast("long"), "full_outer")
    has_c = F.col("title_id").isNotNull() | F.col("title_sk").isNotNull()
    has_s = F.col("_s_title_id").isNotNull()
    changed = F.coalesce(has_c & has_s & (F.col("attr_hash") != F.col("_s_attr_hash")),
                         F.lit(False))
    old = F.struct(*[
        (F.when(changed, F.lit(snap_d)).otherwise(F.col(x)) if x == "valid_to"
         else F.when(changed, F.lit(False)).otherwise(F.col(x)) if x == "is_current"
         else F.col(x)).alias(x)
        for x in DIM_COLS])
    new = F.struct(
        F.xxhash64(F.col("_s_title_id").cast("long"), F.lit(str(snap))).alias("title_sk"),
        F.col("_s_attr_hash").alias("attr_hash"),
        F.col("_s_title_id").cast("long").alias("title_id"),
        *[F.col(f"_s_{a}").alias(a) for a in ATTRS],
        F.lit(snap_d).alias("valid_from"),
        F.lit(dt.date.fromisoformat(HIGH_DATE)).alias("valid_to"),
        F.lit(True).alias("is_current"))
    out = F.array(F.when(has_c, old), F.when(has_s & (~has_c | changed), new))
    closed = dim.filter("NOT is_current").select(*DIM_COLS)
    return j.select(F.inline(F.filter(out, lambda r: r.isNotNull()))).select(*DIM_COLS).unionByName(closed)


def scd2_rebuild(snapshots: DataFrame, snap_col: str = "_snapshot_date") -> DataFrame:
    """Full SCD2 history from all snapshots (applied in ascending date order).

    A version starts wherever a title's hash differs from its previous
    appearance; it ends at the start of the title's next version.
    """
    s = with_attr_hash(snapshots.select(*TITLE_ATTRS, snap_col))
    w = Window.partitionBy("title_id").orderBy(F.col(snap_col))
    starts = (s.withColumn("_prev", F.lag("attr_hash").over(w))
               .filter(F.col("_prev").isNull() | (F.col("_prev") != F.col("attr_hash"))))
    v = _version(starts, F.col(snap_col))
    wv = Window.partitionBy("title_id").orderBy("valid_from")
    nxt = F.lead("valid_from").over(wv)
    v = v.withColumn("valid_to", F.coalesce(nxt, F.col("valid_to")))
    v = v.withColumn("is_current", F.col("valid_to") == F.lit(dt.date.fromisoformat(HIGH_DATE)))
    return v.select(*DIM_COLS)


def scd2_splice(dim: DataFrame, snapshots: DataFrame, late, snap_col: str = "_snapshot_date") -> DataFrame:
    """The dimension after snapshots dated before its newest have come late.

    ``snapshots`` holds the rows of all applied snapshots and of the ``late`` ones. A late
    row that equals the version of its date changes nothing. The titles of the others,
    found by join, get their chain rebuilt from all of their snapshots: a version may begin or end with
    the late one, be cut in two by it, or begin earlier. All other titles' versions pass.
    """
    s = with_attr_hash(snapshots.filter(F.col(snap_col).isin([str(x) for x in late])).select(*TITLE_ATTRS, snap_col))
    s = s.select(F.col("title_id").cast("long").alias("_t"), F.col("attr_hash").alias("_h"), F.to_date(snap_col).alias("_d"))
    held = dim.select("title_id", "attr_hash", "valid_from", "valid_to")
    at = (F.col("_t") == F.col("title_id")) & (F.col("_d") >= F.col("valid_from")) & (F.col("_d") < F.col("valid_to"))
    touched = (s.join(held, at, "left").filter(F.col("attr_hash").isNull() | (F.col("attr_hash") != F.col("_h")))
               .select("_t").distinct())
    chains = scd2_rebuild(snapshots.join(touched, F.col("title_id").cast("long") == F.col("_t"), "left_semi"), snap_col)
    return dim.join(touched, F.col("title_id") == F.col("_t"), "left_anti").select(*DIM_COLS).unionByName(chains)
