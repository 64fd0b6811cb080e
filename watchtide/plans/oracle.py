"""DuckDB SQL that rebuilds each registered query independently of Spark.

Each query is ``WITH <needed CTEs> SELECT …`` over the raw driver tables.
Pitfalls handled: epoch seconds via ``epoch_us // 1e6`` (DuckDB's epoch
rounds), order-preserving distinct of two genres, ``first(… ORDER BY …)``
for the deterministic representative, HALF_UP watch hours in integers.
"""

from __future__ import annotations

from watchtide.plans import fixtures as fx


def _list(vals) -> str:
    return "[" + ", ".join(repr(v) if isinstance(v, str) else str(v) for v in vals) + "]"


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def _hb(title_expr: str) -> str:
    return f"""
  SELECT event_id, user_id,
         CAST({title_expr} AS INTEGER) AS title_id,
         CAST(floor(value * 20) AS INTEGER) AS playback_position_sec,
         CAST({_list(fx.BITRATES)}[event_id % 5 + 1] AS INTEGER) AS bitrate_kbps,
         event_type = 'error' AS is_rebuffering,
         {_list(fx.COUNTRIES)}[user_id % 10 + 1] AS country_code,
         {_list(fx.CDN_POPS)}[event_id % 10 + 1] AS cdn_pop,
         ts AS event_ts,
         {_list(fx.DEVICE_TYPES)}[user_id % 5 + 1] AS device_type,
         {_list(fx.DEVICE_OS)}[user_id % 6 + 1] AS device_os,
         CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) AS _ingest_ts,
         'landing/playback_heartbeats/part-00000.json' AS _source_file,
         CASE WHEN event_id % {fx.RESCUE_EVERY} = 0 THEN 'bad' END AS _rescued_data
  FROM events"""


def _clean(src: str, good_copies: bool = False) -> str:
    src = f"(SELECT * FROM {src} WHERE _rescued_data IS NULL AND event_ts IS NOT NULL AND title_id IS NOT NULL)" if good_copies else src
    return f"""
  SELECT event_id, user_id, title_id, playback_position_sec, bitrate_kbps, is_rebuffering,
         country_code, cdn_pop, event_ts, CAST(event_ts AS DATE) AS event_date,
         device_type, device_os
  FROM (SELECT *, row_number() OVER (PARTITION BY event_id
                    ORDER BY _ingest_ts DESC NULLS LAST, _source_file DESC NULLS LAST) AS rn
        FROM {src})
  WHERE rn = 1 AND _rescued_data IS NULL AND event_ts IS NOT NULL AND title_id IS NOT NULL"""


CTE = {
    "hb": _hb(K),
    "hb_hot": _hb(f"CASE WHEN {K} < {fx.HOT_BELOW} THEN 0 ELSE {K} END"),
    "hb2": f"""
  SELECT * FROM hb
  UNION ALL
  SELECT event_id, user_id, title_id, playback_position_sec + 1, bitrate_kbps, is_rebuffering,
         country_code, cdn_pop, event_ts, device_type, device_os,
         _ingest_ts + INTERVAL 1 DAY, 'landing/playback_heartbeats/part-00001.json',
         CASE WHEN event_id % {fx.REPLAY_EVERY * fx.REPLAY_BAD} = 0 THEN 'bad' END
  FROM hb WHERE event_id % {fx.REPLAY_EVERY} = 0""",
    "silver": _clean("hb"),
    "silver2": _clean("hb2"),
    "silver2_good": _clean("hb2", good_copies=True),
    "silver_hot": _clean("hb_hot"),
    "attrs": """
  SELECT CAST(p_partkey AS BIGINT) AS title_id, p_name AS title_name,
         [split_part(p_name, ' ', -1), lower(p_type)] AS genres, p_brand AS content_type,
         CAST(1970 + p_size AS INTEGER) AS release_year, CAST(30 + 2 * p_size AS INTEGER) AS runtime_min
  FROM part""",
    "v1": f"""
  SELECT * FROM attrs WHERE title_id % {fx.NEW_IN_V2_MOD} <> {fx.NEW_IN_V2_REM}""",
    "v2": f"""
  SELECT title_id, title_name,
         CASE WHEN (release_year - 1970) % {fx.REISSUE_SIZE} = 0 THEN list_append(genres, 'reissue')
              ELSE genres END AS genres,
         CASE WHEN content_type = '{fx.HOUSE_BRAND}' THEN 'house' ELSE content_type END AS content_type,
         release_year, runtime_min
  FROM v1
  UNION ALL
  SELECT * FROM attrs WHERE title_id % {fx.NEW_IN_V2_MOD} = {fx.NEW_IN_V2_REM}""",
    "bronze_titles": f"""
  SELECT *, 'landing/title/{fx.SNAP_V1}/part-00000.json' AS _source_file,
         '{fx.SNAP_V1}' AS _snapshot_date, TIMESTAMP '{fx.SNAP_V1} 06:00:00' AS _ingest_ts FROM v1
  UNION ALL
  SELECT *, 'landing/title/{fx.SNAP_V2}/part-00000.json', '{fx.SNAP_V2}',
         TIMESTAMP '{fx.SNAP_V2} 06:00:00' FROM v2
  UNION ALL
  SELECT title_id, title_name || ' (rev)', genres, content_type, release_year, runtime_min,
         'landing/title/{fx.SNAP_V2}/part-00001.json', '{fx.SNAP_V2}',
         TIMESTAMP '{fx.SNAP_V2} 07:00:00'
  FROM v2 WHERE title_id % {fx.REDELIVER_MOD} = {fx.REDELIVER_REM}""",
    "silver_titles": """
  SELECT title_id, title_name, genres, content_type, release_year, runtime_min,
         _snapshot_date, _source_file, _ingest_ts
  FROM (SELECT *, row_number() OVER (PARTITION BY _snapshot_date, title_id
                    ORDER BY _ingest_ts DESC NULLS LAST, _source_file DESC NULLS LAST) AS rn
        FROM bronze_titles)
  WHERE rn = 1 AND title_id IS NOT NULL""",
    "hashed_titles": """
  SELECT *, sha256(concat_ws('||',
             coalesce(CAST(title_id AS VARCHAR), ''), coalesce(title_name, ''),
             coalesce(array_to_string(genres, ','), ''), coalesce(content_type, ''),
             coalesce(CAST(release_year AS VARCHAR), ''),
             coalesce(CAST(runtime_min AS VARCHAR), ''))) AS attr_hash
  FROM silver_titles""",
    "dim": """
  SELECT attr_hash, title_id, title_name, genres, content_type, release_year, runtime_min,
         valid_from,
         coalesce(lead(valid_from) OVER (PARTITION BY title_id ORDER BY valid_from),
                  DATE '9999-12-31') AS valid_to,
         lead(valid_from) OVER (PARTITION BY title_id ORDER BY valid_from) IS NULL AS is_current
  FROM (SELECT *, CAST(_snapshot_date AS DATE) AS valid_from,
               lag(attr_hash) OVER (PARTITION BY title_id ORDER BY _snapshot_date) AS prev
        FROM hashed_titles)
  WHERE prev IS NULL OR prev <> attr_hash""",
}

# The same chain over snapshots that were delivered once.
CTE["bronze_once"] = CTE["bronze_titles"].rpartition("UNION ALL")[0]
CTE["silver_once"] = CTE["silver_titles"].replace("bronze_titles", "bronze_once")
CTE["hashed_once"] = CTE["hashed_titles"].replace("silver_titles", "silver_once")
CTE["dim_once"] = CTE["dim"].replace("hashed_titles", "hashed_once")

# And over three, of which the middle one may come last.
CTE["mid"] = f"""
  SELECT title_id, title_name, genres, content_type,
         CASE WHEN title_id % {fx.MID_CHANGED} = 0 THEN release_year + 1 ELSE release_year END AS release_year, runtime_min
  FROM v1 WHERE title_id % {fx.MID_ABSENT} <> 0"""
CTE["bronze_three"] = CTE["bronze_once"] + f"""
  UNION ALL
  SELECT *, 'landing/title/{fx.SNAP_MID}/part-00000.json', '{fx.SNAP_MID}', TIMESTAMP '{fx.SNAP_MID} 06:00:00' FROM mid"""
CTE["silver_three"] = CTE["silver_titles"].replace("bronze_titles", "bronze_three")
CTE["hashed_three"] = CTE["hashed_titles"].replace("silver_titles", "silver_three")
CTE["dim_three"] = CTE["dim"].replace("hashed_titles", "hashed_three")

DEPS = {
    "hb2": ["hb"], "silver": ["hb"], "silver2": ["hb", "hb2"], "silver2_good": ["hb", "hb2"], "silver_hot": ["hb_hot"],
    "v1": ["attrs"], "v2": ["attrs", "v1"], "bronze_titles": ["attrs", "v1", "v2"],
    "silver_titles": ["attrs", "v1", "v2", "bronze_titles"],
    "hashed_titles": ["attrs", "v1", "v2", "bronze_titles", "silver_titles"],
    "dim": ["attrs", "v1", "v2", "bronze_titles", "silver_titles", "hashed_titles"],
    "dim_three": ["attrs", "v1", "v2", "mid", "bronze_three", "silver_three", "hashed_three"],
    "dim_once": ["attrs", "v1", "v2", "bronze_once", "silver_once", "hashed_once"],
}


def with_ctes(names, extra: dict | None = None, body: str = "") -> str:
    """``WITH`` clause holding ``names`` (plus dependencies, in order), then ``body``."""
    order = []
    for n in names:
        for d in DEPS.get(n, []) + [n]:
            if d not in order and d in CTE:
                order.append(d)
    parts = [f"{n} AS ({CTE[n]}\n)" for n in order]
    for n, sql in (extra or {}).items():
        parts.append(f"{n} AS ({sql}\n)")
    return "WITH " + ",\n".join(parts) + "\n" + body


def session_rows(src: str, gap: int, lo: str | None = None, hi: str | None = None,
                 keys: str = "user_id, title_id") -> str:
    where = f"WHERE event_date BETWEEN DATE '{lo}' AND DATE '{hi}'" if lo else ""
    return f"""
  SELECT *, CAST(SUM(is_new) OVER (PARTITION BY {keys} ORDER BY event_ts
                  RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_num
  FROM (SELECT *, CASE WHEN epoch_us(event_ts) // 1000000
                            - epoch_us(lag(event_ts) OVER (PARTITION BY {keys}
                                                           ORDER BY event_ts)) // 1000000 > {gap}
                       THEN 1 ELSE 0 END AS is_new
        FROM {src} {where})"""


def session_rollup(src: str, interval: int = 10, keys: str = "user_id, title_id", key: str = "number") -> str:
    key_text = ", ".join(f"CAST({k.strip()} AS VARCHAR)" for k in keys.split(","))
    tail = "session_num" if key == "number" else "epoch_us(MIN(event_ts)) // 1000000"
    return f"""
  SELECT concat_ws('_', {key_text}, CAST({tail} AS VARCHAR)) AS session_key,
         {keys},
         MIN(event_ts) AS session_start, MAX(event_ts) AS session_end,
         CAST(MIN(event_ts) AS DATE) AS session_date,
         COUNT(*) AS heartbeats,
         MAX(playback_position_sec) AS max_position_sec,
         CAST(SUM(CAST(is_rebuffering AS INTEGER)) AS BIGINT) AS rebuffer_events,
         ROUND(AVG(bitrate_kbps), 0) AS avg_bitrate,
         first(country_code ORDER BY event_ts, event_id) AS country_code,
         first(device_type ORDER BY event_ts, event_id) AS device_type,
         COUNT(*) * {interval} AS watch_seconds
  FROM {src}
  GROUP BY {keys}, session_num"""
