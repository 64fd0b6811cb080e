"""Deterministic projection of the driver tables onto the reference's inputs.

``events`` becomes bronze heartbeats, ``part`` becomes two title snapshots.
Every rule is expressible in plain SQL, so the oracle can rebuild the same
rows (see ``watchtide.plans.oracle``). All rows of the source tables are used.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchtide.functions.columns import pick
from watchtide.operators.clean import nest

# ---------------------------------------------------------------------------
# The value pools of the reference's heartbeat generator.
# ---------------------------------------------------------------------------
BITRATES = [480, 720, 1080, 2160, 4000]
COUNTRIES = ["US", "IN", "BR", "GB", "DE", "JP", "MX", "CA", "FR", "KR"]
CDN_POPS = ["iad", "bom", "gru", "lhr", "fra", "nrt", "icn", "lax", "dfw", "sin"]
DEVICE_TYPES = ["smart_tv", "mobile", "web", "tablet", "console"]
DEVICE_OS = ["tizen", "android", "ios", "webos", "roku", "windows"]
# ---------------------------------------------------------------------------

SNAP_V1 = "2024-01-01"
SNAP_V2 = "2024-01-16"
SNAP_MID = "2024-01-08"  # a snapshot between them, for deliveries out of order
MID_ABSENT, MID_CHANGED = 5, 3  # of its titles, ids that divide by 5 are missing and those by 3 have another year
HOT_BELOW = 50  # hot_title_id = 0 when k < 50
RESCUE_EVERY = 97  # event ids divisible by 97 carry rescued data
REPLAY_EVERY = 50  # event ids divisible by 50 are delivered twice
REPLAY_BAD = 3  # of the second deliveries every third is a rescued row, whatever the first was
REISSUE_SIZE = 10  # titles whose size divides by 10 gain a genre in the second snapshot
HOUSE_BRAND = "Brand#7"  # titles of this brand change their type in the second snapshot
NEW_IN_V2_MOD, NEW_IN_V2_REM = 25, 24  # titles with id % 25 = 24 first appear in v2
REDELIVER_MOD, REDELIVER_REM = 7, 3  # v2 titles with id % 7 = 3 are delivered twice


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def heartbeats(spark: SparkSession, sf_dir: str, hot: bool = False) -> DataFrame:
    """Bronze-shaped heartbeats over ``events`` (one row per event)."""
    ev = read(spark, sf_dir, "events")
    k = _k()
    title = F.when(k < HOT_BELOW, F.lit(0)).otherwise(k) if hot else k
    ts = F.col("ts").cast("timestamp")
    flat = ev.select(
        F.col("event_id"), F.col("user_id"),
        title.cast("int").alias("title_id"),
        F.floor(F.col("value") * 20).cast("int").alias("playback_position_sec"),
        pick(BITRATES, F.col("event_id")).cast("int").alias("bitrate_kbps"),
        (F.col("event_type") == F.lit("error")).alias("is_rebuffering"),
        pick(COUNTRIES, F.col("user_id")).alias("country_code"),
        pick(CDN_POPS, F.col("event_id")).alias("cdn_pop"),
        ts.alias("event_ts"),
        F.concat_ws("-", "user_id", F.to_date(ts)).alias("session_id"),
        pick(DEVICE_TYPES, F.col("user_id")).alias("device_type"),
        pick(DEVICE_OS, F.col("user_id")).alias("device_os"),
        F.date_add(F.to_date(ts), 1).cast("timestamp").alias("_ingest_ts"),
        F.lit("landing/playback_heartbeats/part-00000.json").alias("_source_file"),
        F.when(F.pmod(F.col("event_id"), F.lit(RESCUE_EVERY)) == 0, F.lit("bad"))
        .alias("_rescued_data"))
    return nest(flat, "device", ["device_type", "device_os"])


def heartbeats_with_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heartbeats plus a second, later delivery of every 50th event.

    The second copy's rescue flag is its own: it can be bad where the first was good,
    and good where the first was bad.
    """
    hb = heartbeats(spark, sf_dir)
    again = hb.filter(F.pmod(F.col("event_id"), F.lit(REPLAY_EVERY)) == 0).withColumns({
        "_ingest_ts": F.col("_ingest_ts") + F.expr("INTERVAL 1 DAY"),
        "playback_position_sec": F.col("playback_position_sec") + 1,
        "_source_file": F.lit("landing/playback_heartbeats/part-00001.json"),
        "_rescued_data": F.when(F.pmod(F.col("event_id"), F.lit(REPLAY_EVERY * REPLAY_BAD)) == 0, F.lit("bad")),
    })
    return hb.unionByName(again)


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The title catalog over ``part``: a title per part, described by the part's columns."""
    name, kind = F.split("p_name", " "), F.lower("p_type")
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("long").alias("title_id"), F.col("p_name").alias("title_name"),
        F.array(F.element_at(name, -1), kind).alias("genres"), F.col("p_brand").alias("content_type"),
        (F.lit(1970) + F.col("p_size")).cast("int").alias("release_year"),
        (F.lit(30) + 2 * F.col("p_size")).cast("int").alias("runtime_min"))


def _new_in_v2() -> F.Column:
    return F.pmod(F.col("title_id"), F.lit(NEW_IN_V2_MOD)) == NEW_IN_V2_REM


def titles_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return titles(spark, sf_dir).filter(~_new_in_v2())


def titles_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second snapshot: titles of the first with some changed, and new ones."""
    old = ~_new_in_v2()
    size = F.col("release_year") - 1970
    return titles(spark, sf_dir).withColumns({
        "genres": F.when(old & (size % REISSUE_SIZE == 0), F.concat("genres", F.array(F.lit("reissue")))).otherwise(F.col("genres")),
        "content_type": F.when(old & (F.col("content_type") == HOUSE_BRAND), F.lit("house")).otherwise(F.col("content_type")),
    })


def titles_mid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot between: titles of the first, some missing, some of another year."""
    changed = F.pmod(F.col("title_id"), F.lit(MID_CHANGED)) == 0
    return titles_v1(spark, sf_dir).filter(F.pmod(F.col("title_id"), F.lit(MID_ABSENT)) != 0).withColumn(
        "release_year", F.when(changed, F.col("release_year") + 1).otherwise(F.col("release_year")))


def delivered(df: DataFrame, snap: str, part: int = 0, hours: int = 6) -> DataFrame:
    """Titles as bronze rows of one snapshot's file."""
    t = dt.datetime.fromisoformat(snap) + dt.timedelta(hours=hours)
    return df.withColumns({
        "_source_file": F.lit(f"landing/title/{snap}/part-{part:05d}.json"),
        "_snapshot_date": F.lit(snap),
        "_ingest_ts": F.lit(t),
    })


def bronze_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both snapshots as bronze rows; some v2 titles are delivered twice, the
    later copy with a revised name."""
    v2 = titles_v2(spark, sf_dir)
    again = v2.filter(F.pmod(F.col("title_id"), F.lit(REDELIVER_MOD)) == REDELIVER_REM) \
              .withColumn("title_name", F.concat(F.col("title_name"), F.lit(" (rev)")))
    return (delivered(titles_v1(spark, sf_dir), SNAP_V1, 0, 6)
            .unionByName(delivered(v2, SNAP_V2, 0, 6))
            .unionByName(delivered(again, SNAP_V2, 1, 7)))
