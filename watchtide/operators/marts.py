"""Gold facts and business marts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchtide.config import HEARTBEAT_INTERVAL_SEC
from watchtide.operators.clean import date_window
from watchtide.operators.joins import asof_dim_join
from watchtide.schemas import GOLD_FCT_EVENTS, GOLD_FCT_SESSIONS

FCT_EVENT_COLS = [f.name for f in GOLD_FCT_EVENTS.fields]
FCT_SESSION_COLS = [f.name for f in GOLD_FCT_SESSIONS.fields]


def fct_events(events: DataFrame, lo=None, hi=None) -> DataFrame:
    """QoS fact at event grain: window filter + 12-column projection, no join."""
    if lo is not None and hi is not None:
        events = date_window(events, "event_date", lo, hi)
    return events.select(*FCT_EVENT_COLS)


def fct_sessions(sessions: DataFrame, dim: DataFrame, lo=None, hi=None,
                 **join_options) -> DataFrame:
    """Sessions enriched with the title version valid at ``session_date``.

    LEFT join: sessions without a version keep a NULL ``title_sk``. ``join_options``
    go to ``asof_dim_join``.
    """
    if lo is not None and hi is not None:
        sessions = date_window(sessions, "session_date", lo, hi)
    out = asof_dim_join(sessions, dim, "title_id", "session_date", ["title_sk"],
                        how="left", **join_options)
    return out.select(*FCT_SESSION_COLS)


def mart_qos(fct: DataFrame) -> DataFrame:
    """Rebuffer ratio and bitrate by (event_date, cdn_pop, device_type)."""
    rebuf = F.col("is_rebuffering").cast("int")
    return fct.groupBy("event_date", "cdn_pop", "device_type").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.sum(rebuf).alias("rebuffer_events"),
        F.round(F.sum(rebuf) / F.count(F.lit(1)), 4).alias("rebuffer_ratio"),
        F.round(F.avg("bitrate_kbps"), 0).alias("avg_bitrate"))


def mart_engagement(fct: DataFrame, dim: DataFrame,
                    interval_sec: int = HEARTBEAT_INTERVAL_SEC) -> DataFrame:
    """Sessions, distinct users, watch hours and capped completion by
    (session_date, genre, country_code).

    Inner join on ``title_sk`` (facts without a version drop out), then one
    row per genre (a session counts once per genre; empty/NULL genres vanish).
    Whether the dimension is broadcast is left to Spark. ``watch_hours`` is
    DECIMAL, rounded HALF_UP to 2 places; ``avg_completion`` DECIMAL rounded to
    3 places.
    """
    d = dim.select("title_sk", "genres", "runtime_min")
    j = fct.select("title_sk", "session_date", "country_code", "user_id",
                   "heartbeats", "max_position_sec").join(d, "title_sk")
    completion = F.least(
        F.try_divide(F.col("max_position_sec"), F.col("runtime_min") * F.lit(Decimal("60.0"))),
        F.lit(Decimal("1.0")))
    e = j.select("session_date", "country_code", "user_id", "heartbeats",
                 completion.alias("_completion"), F.explode("genres").alias("genre"))
    return e.groupBy("session_date", "genre", "country_code").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.count_distinct("user_id").alias("distinct_users"),
        F.round(F.sum(F.col("heartbeats") * F.lit(interval_sec)) / F.lit(Decimal("3600.0")), 2)
        .alias("watch_hours"),
        F.round(F.avg("_completion"), 3).alias("avg_completion"))
