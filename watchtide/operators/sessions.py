"""Gap-based sessionization and the session roll-up.

Semantics: within one key, ordered by event time, a row opens a new session when
the difference of the *floored* epoch seconds to the previous row is greater than
``gap_seconds``; the first row of a key does not count as new, so session numbers
start at ``first_index`` (0). Rows of one second always share a session.

Scale design. Only the floored second decides, and every measure merges, so events
are first summed by key and second (partial sums before the shuffle: a key leaves
each map task with one row per second at most, however many events it has), and the
windows run over seconds. What one task holds of a hot key is bounded by the seconds
of the time span, not by events. ``by_second=False`` is the plain form, one window
over the rows themselves; results are equal.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchtide.config import GAP_SECONDS, HEARTBEAT_INTERVAL_SEC
from watchtide.functions.columns import epoch_seconds
from watchtide.operators.clean import date_window

KEYS = ("user_id", "title_id")


def _number(rows: DataFrame, keys, order: str, sec: Column, gap: int, first_index: int, out: str) -> DataFrame:
    """Add the session number ``out`` per key, rows in the given order."""
    w = Window.partitionBy(*keys).orderBy(order)
    # no previous row compares to NULL -> not new
    new = F.when(sec - F.lag(sec).over(w) > F.lit(gap), 1).otherwise(0)
    return (rows.withColumn("_new", new)
            .withColumn(out, F.sum("_new").over(w) + F.lit(first_index)).drop("_new"))


def sessionize(df: DataFrame, keys=KEYS, ts_col: str = "event_ts",
               gap_seconds: int = GAP_SECONDS, first_index: int = 0,
               by_second: bool = True, out_col: str = "session_num") -> DataFrame:
    """Add ``session_num`` to every row (per key, from ``first_index``).

    By second, rows move once: to meet the numbers of their key's seconds.
    """
    keys = list(keys)
    if not by_second:
        return _number(df, keys, ts_col, epoch_seconds(ts_col), gap_seconds, first_index, out_col)
    rows = df.withColumn("_sec", epoch_seconds(ts_col))
    seconds = rows.select(*keys, "_sec").distinct()
    numbered = _number(seconds, keys, "_sec", F.col("_sec"), gap_seconds, first_index, out_col)
    n = numbered.select(*[F.col(c).alias(f"_n_{c}") for c in [*keys, "_sec"]], out_col)
    cond = [rows[c].eqNullSafe(n[f"_n_{c}"]) for c in [*keys, "_sec"]]
    return rows.join(n, cond).select(*df.columns, out_col)


def _session_columns(keys, session_num: str, interval_sec: int, key: str) -> list:
    tail = F.col(session_num) if key == "number" else epoch_seconds("session_start")
    return [
        F.concat_ws("_", *[F.col(k) for k in keys], tail).alias("session_key"),
        *[F.col(k) for k in keys],
        F.col("session_start"), F.col("session_end"),
        F.to_date("session_start").alias("session_date"),
        F.col("heartbeats"), F.col("max_position_sec"), F.col("rebuffer_events"),
        F.col("avg_bitrate"),
        F.col("_first.country_code").alias("country_code"),
        F.col("_first.device_type").alias("device_type"),
        (F.col("heartbeats") * F.lit(interval_sec)).alias("watch_seconds"),
    ]


def _measures(ts_col: str, tie_col: str) -> list:
    """What is summed of events, in a form that can be merged again (:func:`_merged`)."""
    first = F.struct(F.col(ts_col).alias("t"), F.col(tie_col).alias("i"))
    return [F.min(ts_col).alias("_from"), F.max(ts_col).alias("_to"), F.count(F.lit(1)).alias("_n"),
            F.max("playback_position_sec").alias("_pos"), F.sum(F.col("is_rebuffering").cast("int")).alias("_rebuf"),
            F.sum(F.col("bitrate_kbps").cast("long")).alias("_rate"), F.count("bitrate_kbps").alias("_rates"),
            F.min(first).alias("_order"), F.min_by(F.struct("country_code", "device_type"), first).alias("_value")]


def _merged() -> list:
    return [F.min("_from").alias("_from"), F.max("_to").alias("_to"), F.sum("_n").alias("_n"), F.max("_pos").alias("_pos"),
            F.sum("_rebuf").alias("_rebuf"), F.sum("_rate").alias("_rate"), F.sum("_rates").alias("_rates"),
            F.min_by("_value", "_order").alias("_value"), F.min("_order").alias("_order")]


def _sessions_of(parts: DataFrame, keys, interval_sec: int, key: str) -> DataFrame:
    """Parts of sessions, numbered ``_sn`` -> one row per session."""
    agg = parts.groupBy(*keys, "_sn").agg(
        F.min("_from").alias("session_start"), F.max("_to").alias("session_end"),
        F.sum("_n").alias("heartbeats"), F.max("_pos").alias("max_position_sec"),
        F.sum("_rebuf").alias("rebuffer_events"),
        F.round(F.try_divide(F.sum("_rate").cast("double"), F.sum("_rates")), 0).alias("avg_bitrate"),
        F.min_by("_value", "_order").alias("_first"))
    return agg.select(*_session_columns(keys, "_sn", interval_sec, key))


def rollup_sessions(events: DataFrame, keys=KEYS, ts_col: str = "event_ts",
                    gap_seconds: int = GAP_SECONDS,
                    interval_sec: int = HEARTBEAT_INTERVAL_SEC, first_index: int = 0,
                    by_second: bool = True, tie_col: str = "event_id", key: str = "number") -> DataFrame:
    """Sessionize silver events and roll each session up to one row.

    Output follows ``silver.viewing_sessions``. The representative
    ``country_code``/``device_type`` come from the session's first event by
    ``(event_ts, event_id)`` — a deterministic stand-in for ``FIRST``.
    ``session_key`` ends in the session's number, which depends on the events read,
    or with ``key="start"`` in its first epoch second, which doesn't.
    """
    keys = list(keys)
    one = _measures(ts_col, tie_col)
    if by_second:
        seconds = events.groupBy(*keys, epoch_seconds(ts_col).alias("_sec")).agg(*one)
        parts = _number(seconds, keys, "_sec", F.col("_sec"), gap_seconds, first_index, "_sn")
    else:
        rows = sessionize(events, keys, ts_col, gap_seconds, first_index, False, "_sn")
        parts = rows.groupBy(*keys, "_sn").agg(*one)
    return _sessions_of(parts, keys, interval_sec, key)


def rollup_sessions_by_day(events: DataFrame, keys=KEYS, ts_col: str = "event_ts", gap_seconds: int = GAP_SECONDS,
                           interval_sec: int = HEARTBEAT_INTERVAL_SEC, first_index: int = 0, tie_col: str = "event_id",
                           key: str = "number") -> DataFrame:
    """:func:`rollup_sessions` in two levels, for keys that are alive for years.

    Runs of seconds are found within each (key, day). A run can go on over midnight only from the last of
    one day to the first of the key's next day, so days are then put in order by their first and
    last second alone: a day tells whether its first run continues a session, and how many sessions there
    were before. Windows hold the seconds of one key and day, or one row per day of a key.
    """
    keys = list(keys)
    seconds = events.groupBy(*keys, epoch_seconds(ts_col).alias("_sec")).agg(*_measures(ts_col, tie_col))
    seconds = seconds.withColumn("_day", F.floor(F.col("_sec") / 86400))
    runs = _number(seconds, [*keys, "_day"], "_sec", F.col("_sec"), gap_seconds, 0, "_run")
    runs = runs.groupBy(*keys, "_day", "_run").agg(F.min("_sec").alias("_at"), F.max("_sec").alias("_till"), *_merged())
    days = runs.groupBy(*keys, "_day").agg(F.min("_at").alias("_begin"), F.max("_till").alias("_end"), F.count(F.lit(1)).alias("_runs"))
    w = Window.partitionBy(*keys).orderBy("_day")
    apart = F.coalesce(F.col("_begin") - F.lag("_end").over(w) > F.lit(gap_seconds), F.lit(False))
    days = days.withColumn("_joined", ((F.row_number().over(w) > 1) & ~apart).cast("long"))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum(F.col("_runs") - F.col("_joined")).over(before), F.lit(0)) - F.col("_joined")
    d = days.select(*[F.col(k).alias(f"_d_{k}") for k in keys], F.col("_day").alias("_d_day"), base.alias("_base"))
    on = [runs[k].eqNullSafe(d[f"_d_{k}"]) for k in keys] + [runs["_day"].eqNullSafe(d["_d_day"])]
    parts = runs.join(d, on).withColumn("_sn", F.col("_base") + F.col("_run") + F.lit(first_index))
    return _sessions_of(parts, keys, interval_sec, key)


def flagged_sessions(events: DataFrame, lo, hi, pad_days: int = 1, gap_seconds: int = GAP_SECONDS,
                     date_col: str = "event_date", **options) -> tuple[DataFrame, tuple[str, str]]:
    """Sessions to be replaced after events dated ``lo`` to ``hi`` have changed (``_inside``) and
    those that their scope is too narrow for (``_beyond``), in one table, and the scope.

    The scope is ``[lo - pad, hi + pad]``. Events are read from further out by the
    days a gap can span, so that no session of the scope is cut at its edges: what
    starts before the scope is left to its own rows, what starts inside is whole, unless it ends within a gap of
    the first second that wasn't read. If a row is ``_beyond``, it is such a session, or sessions touched by the
    change reach beyond the scope, and the caller widens it.
    """
    day = dt.timedelta(days=1)
    lo, hi = dt.date.fromisoformat(str(lo)), dt.date.fromisoformat(str(hi))
    edge = 1 + gap_seconds // 86400
    a, b = lo - pad_days * day, hi + pad_days * day
    s = rollup_sessions(date_window(events, date_col, a - edge * day, b + edge * day),
                        gap_seconds=gap_seconds, key="start", **options)
    start, end = F.col("session_date"), F.to_date("session_end")
    touched = (start <= F.lit(hi)) & (end >= F.lit(lo))
    inside = start.between(F.lit(a), F.lit(b))
    unread = epoch_seconds(F.lit(b + (edge + 1) * day).cast("timestamp"))
    cut_off = unread - epoch_seconds("session_end") <= F.lit(gap_seconds)
    beyond = (touched & ((start < F.lit(a)) | (end > F.lit(b)))) | (inside & cut_off)
    return s.withColumns({"_inside": inside, "_beyond": beyond}).filter("_inside OR _beyond"), (str(a), str(b))


def rows_of_keys(events: DataFrame, found: DataFrame, keys=KEYS) -> DataFrame:
    """The events of the keys in ``found`` (NULL is a key)."""
    k = found.select(*[F.col(c).alias(f"_k_{c}") for c in keys])
    cond = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys]
    return events.join(k, cond, "left_semi")


def scoped_sessions(events: DataFrame, lo, hi, pad_days: int = 1, gap_seconds: int = GAP_SECONDS,
                    date_col: str = "event_date", **options) -> tuple[DataFrame, DataFrame, tuple[str, str]]:
    """:func:`flagged_sessions` as two tables: the sessions to be replaced, and those beyond."""
    s, scope = flagged_sessions(events, lo, hi, pad_days, gap_seconds, date_col, **options)
    plain = [c for c in s.columns if c not in ("_inside", "_beyond")]
    return s.filter("_inside").select(*plain), s.filter("_beyond").select(*plain), scope
