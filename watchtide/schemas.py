"""Table contracts: one StructType per table plus its partition column."""

from __future__ import annotations

from pyspark.sql import types as T

DEVICE = T.StructType([
    T.StructField("device_type", T.StringType()),
    T.StructField("device_os", T.StringType()),
])

RAW_HEARTBEAT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("title_id", T.IntegerType()),
    T.StructField("playback_position_sec", T.IntegerType()),
    T.StructField("bitrate_kbps", T.IntegerType()),
    T.StructField("is_rebuffering", T.BooleanType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("cdn_pop", T.StringType()),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("device", DEVICE),
])

RAW_TITLE = T.StructType([
    T.StructField("title_id", T.LongType()),
    T.StructField("title_name", T.StringType()),
    T.StructField("genres", T.ArrayType(T.StringType())),
    T.StructField("content_type", T.StringType()),
    T.StructField("release_year", T.IntegerType()),
    T.StructField("runtime_min", T.IntegerType()),
])

BRONZE_HEARTBEAT = T.StructType(RAW_HEARTBEAT.fields + [
    T.StructField("_ingest_ts", T.TimestampType()),
    T.StructField("_source_file", T.StringType()),
    T.StructField("_rescued_data", T.StringType()),
    T.StructField("_unknown_fields", T.StringType()),
    T.StructField("_ingest_date", T.DateType()),
])

BRONZE_TITLE = T.StructType(RAW_TITLE.fields + [
    T.StructField("_rescued_data", T.StringType()),
    T.StructField("_unknown_fields", T.StringType()),
    T.StructField("_source_file", T.StringType()),
    T.StructField("_snapshot_date", T.StringType()),
    T.StructField("_ingest_ts", T.TimestampType()),
])

SILVER_EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("title_id", T.IntegerType()),
    T.StructField("playback_position_sec", T.IntegerType()),
    T.StructField("bitrate_kbps", T.IntegerType()),
    T.StructField("is_rebuffering", T.BooleanType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("cdn_pop", T.StringType()),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("device_os", T.StringType()),
])

SILVER_SESSIONS = T.StructType([
    T.StructField("session_key", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("title_id", T.IntegerType()),
    T.StructField("session_start", T.TimestampType()),
    T.StructField("session_end", T.TimestampType()),
    T.StructField("session_date", T.DateType()),
    T.StructField("heartbeats", T.LongType()),
    T.StructField("max_position_sec", T.IntegerType()),
    T.StructField("rebuffer_events", T.LongType()),
    T.StructField("avg_bitrate", T.DoubleType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("watch_seconds", T.LongType()),
])

SILVER_TITLE = T.StructType(RAW_TITLE.fields + [
    T.StructField("_snapshot_date", T.StringType()),
    T.StructField("_source_file", T.StringType()),
    T.StructField("_ingest_ts", T.TimestampType()),
])

GOLD_DIM_TITLE = T.StructType([
    T.StructField("title_sk", T.LongType()),
    T.StructField("attr_hash", T.StringType()),
    T.StructField("title_id", T.LongType()),
    T.StructField("title_name", T.StringType()),
    T.StructField("genres", T.ArrayType(T.StringType())),
    T.StructField("content_type", T.StringType()),
    T.StructField("release_year", T.IntegerType()),
    T.StructField("runtime_min", T.IntegerType()),
    T.StructField("valid_from", T.DateType()),
    T.StructField("valid_to", T.DateType()),
    T.StructField("is_current", T.BooleanType()),
])

GOLD_FCT_SESSIONS = T.StructType([
    T.StructField("session_key", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("title_id", T.IntegerType()),
    T.StructField("title_sk", T.LongType()),
    T.StructField("session_start", T.TimestampType()),
    T.StructField("session_end", T.TimestampType()),
    T.StructField("session_date", T.DateType()),
    T.StructField("heartbeats", T.LongType()),
    T.StructField("max_position_sec", T.IntegerType()),
    T.StructField("rebuffer_events", T.LongType()),
    T.StructField("avg_bitrate", T.DoubleType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("device_type", T.StringType()),
])

GOLD_FCT_EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("title_id", T.IntegerType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("cdn_pop", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("device_os", T.StringType()),
    T.StructField("bitrate_kbps", T.IntegerType()),
    T.StructField("is_rebuffering", T.BooleanType()),
    T.StructField("playback_position_sec", T.IntegerType()),
])

#: Bloom filters of a date's keys, a row per block and write (operators.membership).
SEEN_KEYS = T.StructType([
    T.StructField("blocks", T.IntegerType()),
    T.StructField("block", T.IntegerType()),
    T.StructField("bits", T.BinaryType()),
    T.StructField("event_date", T.DateType()),
])

SCHEMAS = {
    "bronze/playback_heartbeats": BRONZE_HEARTBEAT,
    "bronze/dim_title": BRONZE_TITLE,
    "silver/playback_events": SILVER_EVENTS,
    "silver/viewing_sessions": SILVER_SESSIONS,
    "silver/dim_title": SILVER_TITLE,
    "gold/dim_title": GOLD_DIM_TITLE,
    "gold/fct_viewing_sessions": GOLD_FCT_SESSIONS,
    "gold/fct_playback_events": GOLD_FCT_EVENTS,
}

PARTITIONS = {
    "silver/playback_events": "event_date",
    "silver/viewing_sessions": "session_date",
    "silver/dim_title": "_snapshot_date",
    "gold/fct_viewing_sessions": "session_date",
    "gold/fct_playback_events": "event_date",
}


def conform(df, schema: T.StructType):
    """Select the contract's columns in order, casting where types differ."""
    from pyspark.sql import functions as F

    have = dict(df.dtypes)
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if have.get(f.name) != f.dataType.simpleString():
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)
