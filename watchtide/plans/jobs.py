"""Loaders: one function per pipeline job, in dependency order.

Each loader reads its inputs from shared storage, runs the pure operators and
writes its output. State passes between loaders only through tables and the ledger
(``_ops/ledger``): before a loader commits a change, it enters the dates that the loaders
after it have to do again, and these strike the entry after their own write. So a run may
die anywhere and be run again, with the same date or a later one, and re-running a step is
idempotent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchtide.config import PipelineConfig
from watchtide.operators.clean import clean_events, clean_titles, ingest_day, snapshot
from watchtide.operators.marts import fct_events, fct_sessions, mart_engagement, mart_qos
from watchtide.operators.membership import blocks_of, filter_rows, insert_unseen, maybe_seen
from watchtide.operators.scd2 import DIM_COLS, empty_dim, scd2_apply, scd2_splice
from watchtide.operators.scope import date_ranges, days_between, full_window, in_ranges, window_for
from watchtide.operators.sessions import KEYS, flagged_sessions, rollup_sessions, rows_of_keys
from watchtide.operators.titles import pending_list
from watchtide.schemas import (BRONZE_HEARTBEAT, BRONZE_TITLE, GOLD_DIM_TITLE, GOLD_FCT_EVENTS, GOLD_FCT_SESSIONS,
                               SEEN_KEYS, SILVER_EVENTS, SILVER_SESSIONS, SILVER_TITLE, conform)
from watchtide.session import apply_defaults, apply_scale, window_sized
from watchtide.sources.notes import Ledger, load_note, save_note
from watchtide.sources.tables import (RunReport, append_table, drop_folder, drop_partition, move_folder, overwrite_dates,
                                      overwrite_partition, partition_values, read_table, replace_table, table_exists,
                                      write_table)
from watchtide.streaming.bronze import ingest_heartbeats, ingest_titles


def _table(spark, cfg: PipelineConfig, layer: str, name: str, schema) -> DataFrame:
    """A table by its contract; an empty one if nothing was ever written to it."""
    path = cfg.path(layer, name)
    return read_table(spark, path, schema) if table_exists(spark, path) else spark.createDataFrame([], schema)


def _ledger(spark: SparkSession, cfg: PipelineConfig) -> Ledger:
    return Ledger(spark, f"{cfg.ops}/ledger")


def _ranges(df: DataFrame, col: str, processing_date, lookback: int, dates=()) -> list[tuple[str, str]]:
    """What a scoped load replaces: the lookback window of its date and ``dates`` from a late
    delivery; without a processing date, all there is."""
    if not processing_date:
        w = full_window(df, col)
        return [w] if w else []
    return date_ranges([*days_between(*window_for(processing_date, lookback)), *dates])


def load_bronze(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """Incremental ingestion of both landing folders (availableNow streams); fields that
    come new in a delivery are added to the stored schemas."""
    land = cfg.landing.rstrip("/")
    return {
        "heartbeats": ingest_heartbeats(spark, f"{land}/playback_heartbeats",
                                        cfg.path("bronze", "playback_heartbeats"),
                                        f"{cfg.ops}/checkpoints/playback_heartbeats",
                                        schema_store=f"{cfg.ops}/schemas/playback_heartbeats"),
        "titles": ingest_titles(spark, f"{land}/title", cfg.path("bronze", "dim_title"),
                                f"{cfg.ops}/checkpoints/title", schema_store=f"{cfg.ops}/schemas/title"),
    }


def _seen_events(spark: SparkSession, cfg: PipelineConfig, dates) -> DataFrame:
    """The filters of what silver holds of some dates. They are written before the events are, so
    they say of no stored event that it wasn't seen."""
    path = f"{cfg.ops}/seen_events"
    if not table_exists(spark, path):
        return spark.createDataFrame([], SEEN_KEYS)
    return read_table(spark, path, SEEN_KEYS).filter(in_ranges("event_date", date_ranges(dates)))


def load_events(spark: SparkSession, cfg: PipelineConfig, ingest_date=None,
                filter_first: bool = False) -> RunReport:
    """Bronze slice -> cleaned events appended to silver when not yet present.

    The slice is read and cleaned once, into a staging table partitioned by event date: its
    folders name the dates, which are owed to the loaders of sessions and event facts before the append
    commits. Only events that the filters of their date take for seen are compared with the target, and only
    with the dates of those; they are told apart once, in a second staging table. What a filter takes for
    seen has all its bits there, so only other keys are added. The report's dates are those that got new
    events, however late these came; only they stay owed when the append has gone well.
    """
    bronze = _table(spark, cfg, "bronze", "playback_heartbeats", BRONZE_HEARTBEAT)
    if ingest_date:  # partition pruning to the one ingest day, then its exact bounds
        bronze = bronze.filter(F.col("_ingest_date") == F.lit(str(ingest_date)).cast("date"))
        bronze = ingest_day(bronze, ingest_date)
    stage = f"{cfg.ops}/staging/playback_events"
    write_table(clean_events(bronze, filter_first=filter_first), stage, partition_by="event_date")
    dates = partition_values(spark, stage, "event_date")
    if not dates:
        return RunReport()
    staged = read_table(spark, stage, SILVER_EVENTS)
    target_path = cfg.path("silver", "playback_events")
    new, held, seen = staged, partition_values(spark, target_path, "event_date"), _seen_events(spark, cfg, dates)
    added, told = staged, f"{cfg.ops}/staging/playback_events_told"
    unheld = in_ranges("event_date", date_ranges(set(dates) - set(held)))
    if held:
        target = read_table(spark, target_path, SILVER_EVENTS).filter(in_ranges("event_date", date_ranges(dates)))
        write_table(maybe_seen(staged, seen, ["event_id"], "event_date"), told, partition_by=["maybe_seen", "event_date"])
        flagged = read_table(spark, told, T.StructType([*SILVER_EVENTS.fields, T.StructField("maybe_seen", T.BooleanType())]))
        new = insert_unseen(target, staged, ["event_id"], "event_date", seen, flagged)
        added = flagged.filter(~F.col("maybe_seen") | unheld)
    # a date that silver already holds without a filter stays without: its rows are compared exactly
    fresh = staged.filter(unheld)
    known = seen.groupBy("event_date").agg(F.min("blocks").alias("blocks"))  # what a date was first written with holds
    blocks = known.unionByName(blocks_of(fresh, "event_date").join(known, "event_date", "left_anti"))
    write_table(conform(filter_rows(added, ["event_id"], "event_date", blocks), SEEN_KEYS), f"{cfg.ops}/seen_events", "append", "event_date")
    ledger = _ledger(spark, cfg)
    first = {x: ledger.owe(x, dates) for x in ("sessions", "fct_events")}
    report = append_table(new, target_path, partition_by="event_date")
    for x, entries in first.items():
        ledger.owe(x, report.dates)
        ledger.strike(x, entries)
    drop_folder(spark, stage)
    drop_folder(spark, told)
    return report


def load_sessions(spark: SparkSession, cfg: PipelineConfig, processing_date=None, dates=()) -> list[tuple[str, str]]:
    """Recompute sessions that events of a window, of ``dates`` or of owed dates can have changed.

    A changed date can alter sessions that began the day before or go on the day
    after, so the scope replaced is that much wider, and it is widened further as long
    as sessions reach beyond it. Sessions are computed into a staging table, which tells whether the
    scope will do and from which it is replaced; wider scopes are tried on the keys that reach beyond alone, and then
    computed for all. Returns the ranges of session dates replaced.
    """
    events = _table(spark, cfg, "silver", "playback_events", SILVER_EVENTS)
    out_path = cfg.path("silver", "viewing_sessions")
    options = {"gap_seconds": cfg.gap_seconds, "interval_sec": cfg.interval_sec}
    pad = 1 + cfg.gap_seconds // 86400
    ledger, done = _ledger(spark, cfg), []
    owed = ledger.owed("sessions")
    if not processing_date:
        for lo, hi in _ranges(events, "event_date", None, 0):
            sessions = rollup_sessions(events, key="start", **options)
            ledger.owe("fct_sessions", since=lo)
            overwrite_dates(conform(sessions, SILVER_SESSIONS), out_path, "session_date", lo, hi)
            done.append((lo, hi))
        ledger.strike("sessions", owed.entries)
        return done
    stage, stage_keys = f"{cfg.ops}/staging/viewing_sessions", f"{cfg.ops}/staging/viewing_sessions_beyond"
    changed = _ranges(events, "event_date", processing_date, cfg.session_lookback_days, {*dates, *owed.dates})
    for lo, hi in date_ranges([d for r in changed for d in days_between(*r)], join_days=4 * pad):
        width = pad
        while True:
            flagged, scope = flagged_sessions(events, lo, hi, width, **options)
            write_table(flagged, stage)
            staged = read_table(spark, stage, flagged.schema)
            if staged.filter("_beyond").isEmpty():
                break
            write_table(staged.filter("_beyond").select(*KEYS).distinct(), stage_keys)
            few = rows_of_keys(events, read_table(spark, stage_keys, staged.select(*KEYS).schema))
            width *= 2
            while not flagged_sessions(few, lo, hi, width, **options)[0].filter("_beyond").isEmpty():
                width *= 2
        ledger.owe("fct_sessions", days_between(*scope))
        overwrite_dates(conform(staged.filter("_inside"), SILVER_SESSIONS), out_path, "session_date", *scope)
        done.append(scope)
    drop_folder(spark, stage)
    drop_folder(spark, stage_keys)
    ledger.strike("sessions", owed.entries)
    return done


def load_titles(spark: SparkSession, cfg: PipelineConfig, force=()) -> list[str]:
    """Clean every bronze snapshot not yet in silver (plus ``force``), oldest first."""
    bronze = _table(spark, cfg, "bronze", "dim_title", BRONZE_TITLE)
    pending = pending_list(bronze, _table(spark, cfg, "silver", "dim_title", SILVER_TITLE))
    todo = sorted(set(pending) | {str(s) for s in force})
    for snap in todo:
        with window_sized(spark):
            overwrite_partition(clean_titles(bronze, snap), cfg.path("silver", "dim_title"), "_snapshot_date", snap)
    return todo


def _state(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """The published state of the dimension from the bookkeeping folder: the snapshots it holds, and
    of each state kept (the last is the one to read) the folders of current and closed versions."""
    return load_note(spark, f"{cfg.ops}/dim_title_state") or {"applied": [], "states": []}


def _read_state(spark: SparkSession, cfg: PipelineConfig, state: dict) -> tuple[DataFrame, DataFrame | None]:
    """Current versions of a state, and the closed ones (None if there are none)."""
    root = cfg.path("gold", "dim_title")
    schema = T.StructType([f for f in GOLD_DIM_TITLE.fields if f.name != "is_current"])
    part = lambda paths, now: spark.read.schema(schema).parquet(*paths).withColumn("is_current", F.lit(now)).select(*DIM_COLS)
    closed = [f"{root}/closed={x}" for x in state["closed"]]
    return part([f"{root}/asof={state['asof']}"], True), part(closed, False) if closed else None


def read_dim(spark: SparkSession, cfg: PipelineConfig) -> DataFrame | None:
    """The published state of the SCD2 dimension."""
    states = _state(spark, cfg)["states"]
    if not states:
        return None
    now, closed = _read_state(spark, cfg, states[-1])
    return now if closed is None else now.unionByName(closed)


def _publish_dim(spark: SparkSession, cfg: PipelineConfig, dim: DataFrame, name: str) -> bool:
    """Write a state's current versions to ``asof=<name>`` and, if there are any, the closed
    versions that come with it to ``closed=<name>``, in one job."""
    root = cfg.path("gold", "dim_title")
    with window_sized(spark):
        dim.write.mode("overwrite").partitionBy("is_current").parquet(f"{root}/_next")
    if not move_folder(spark, f"{root}/_next/is_current=true", f"{root}/asof={name}"):
        spark.createDataFrame([], GOLD_DIM_TITLE).drop("is_current").write.parquet(f"{root}/asof={name}")
    closed = move_folder(spark, f"{root}/_next/is_current=false", f"{root}/closed={name}")
    drop_folder(spark, f"{root}/_next")
    return closed


def load_dim(spark: SparkSession, cfg: PipelineConfig, keep_states: int = 3) -> list[str]:
    """Apply silver snapshots that the SCD2 dimension doesn't hold yet.

    Snapshots newer than the newest applied one are applied oldest first. Each state's current versions
    go to a folder of their own, ``asof=<snapshot>``, and the versions it closed to
    ``closed=<snapshot>``, which later states share: history is written once. Snapshots
    that come late are spliced into the history together, which is then written anew. A state
    counts when its note is stored; facts from the first snapshot on are owed before that. The newest
    ``keep_states`` states stay. If the note is lost, the next run builds the dimension
    again from all snapshots.
    """
    silver = _table(spark, cfg, "silver", "dim_title", SILVER_TITLE)
    root, ledger, note = cfg.path("gold", "dim_title"), _ledger(spark, cfg), f"{cfg.ops}/dim_title_state"
    state = _state(spark, cfg)
    pending = pending_list(silver, spark.createDataFrame([(s,) for s in state["applied"]], "_snapshot_date string"))
    newest = max(state["applied"], default="")
    late = [s for s in pending if s < newest]
    for batch in [late] * bool(late) + [[s] for s in pending if s > newest]:
        states, applied = state["states"], sorted({*state["applied"], *batch})
        if batch is late:
            of_all = silver.filter(F.col("_snapshot_date").isin(applied))
            name = f"{newest}.{len(applied)}"  # not the folder that is read
            closed = _publish_dim(spark, cfg, scd2_splice(read_dim(spark, cfg), of_all, late), name)
            kept = []
        else:
            now = _read_state(spark, cfg, states[-1])[0] if states else empty_dim(spark)
            name = batch[0]
            closed = _publish_dim(spark, cfg, scd2_apply(now, snapshot(silver, name), name), name)
            kept = states[-1]["closed"] if states else []
        state = {"applied": applied, "states": [*states, {"asof": name, "closed": [*kept, name] if closed else kept}][-keep_states:]}
        ledger.owe("fct_sessions", since=batch[0])
        save_note(spark, state, note)
    used = {"asof": {s["asof"] for s in state["states"]}, "closed": {x for s in state["states"] for x in s["closed"]}}
    for kind, names in used.items():
        for old in set(partition_values(spark, root, kind)) - names:
            drop_partition(spark, root, kind, old)
    return pending


def load_fct_events(spark: SparkSession, cfg: PipelineConfig, processing_date=None, dates=()) -> list[RunReport]:
    """Event facts of the window, of late ``dates`` and of owed ones, replaced."""
    events = _table(spark, cfg, "silver", "playback_events", SILVER_EVENTS)
    ledger = _ledger(spark, cfg)
    owed = ledger.owed("fct_events")
    out = [overwrite_dates(fct_events(events, lo, hi), cfg.path("gold", "fct_playback_events"), "event_date", lo, hi)
           for lo, hi in _ranges(events, "event_date", processing_date, cfg.event_fact_lookback_days, {*dates, *owed.dates})]
    ledger.strike("fct_events", owed.entries)
    return out


def load_fct_sessions(spark: SparkSession, cfg: PipelineConfig, processing_date=None, dates=()) -> list[RunReport]:
    """Session facts of the window, of ``dates`` and of what is owed (dates of replaced sessions, and
    all from a new title snapshot on), replaced."""
    sessions = _table(spark, cfg, "silver", "viewing_sessions", SILVER_SESSIONS)
    dim = read_dim(spark, cfg)
    dim = empty_dim(spark) if dim is None else dim
    ledger = _ledger(spark, cfg)
    owed = ledger.owed("fct_sessions")
    again = {*dates, *owed.dates}
    if owed.since:
        again |= {d for d in partition_values(spark, cfg.path("silver", "viewing_sessions"), "session_date") if d >= owed.since}
    out = [overwrite_dates(fct_sessions(sessions, dim, lo, hi), cfg.path("gold", "fct_viewing_sessions"), "session_date", lo, hi)
           for lo, hi in _ranges(sessions, "session_date", processing_date, cfg.session_fact_lookback_days, again)]
    ledger.strike("fct_sessions", owed.entries)
    return out


def load_marts(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Full rebuild of both marts (small aggregates, always consistent)."""
    dim = read_dim(spark, cfg)
    fs = _table(spark, cfg, "gold", "fct_viewing_sessions", GOLD_FCT_SESSIONS)
    fe = _table(spark, cfg, "gold", "fct_playback_events", GOLD_FCT_EVENTS)
    engagement = mart_engagement(fs, empty_dim(spark) if dim is None else dim, cfg.interval_sec)
    replace_table(engagement, cfg.path("gold", "mart_engagement"))
    replace_table(mart_qos(fe), cfg.path("gold", "mart_qos"))


def run_day(spark: SparkSession, cfg: PipelineConfig, processing_date=None, ingest_date=None,
            input_bytes: int | None = None, cores: int = 8, after: Callable[[str], None] | None = None) -> dict:
    """Every loader once, in dependency order.

    Session and fact loads replace the window of the processing date and what the ledger
    says they owe: every date that got events, however late, and facts of sessions from a newly
    applied title snapshot on. A run that died is simply run again. With ``input_bytes`` the
    session's shuffle settings are sized for the run; ``after`` is told the name of each loader that
    has ended.
    """
    apply_defaults(spark)
    if input_bytes:
        apply_scale(spark, input_bytes, cores, window_heavy=True)
    loaders = {
        "bronze": lambda: load_bronze(spark, cfg),
        "events": lambda: load_events(spark, cfg, ingest_date),
        "titles": lambda: load_titles(spark, cfg),
        "dim": lambda: load_dim(spark, cfg),
        "fct_events": lambda: load_fct_events(spark, cfg, processing_date),
        "sessions": lambda: load_sessions(spark, cfg, processing_date),
        "fct_sessions": lambda: load_fct_sessions(spark, cfg, processing_date),
        "marts": lambda: load_marts(spark, cfg),
    }
    if not cfg.landing:
        del loaders["bronze"]
    out: dict = {}
    for name, load in loaders.items():
        out[name] = load()
        if after:
            after(name)
    return out
