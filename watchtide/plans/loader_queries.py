"""Queries over whole loads: runs that die, snapshots out of order, keys seen before, versions in order."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from watchtide.config import PipelineConfig
from watchtide.operators.clean import clean_events
from watchtide.operators.joins import asof_merged
from watchtide.operators.membership import blocks_of, filter_rows, insert_unseen, maybe_seen
from watchtide.operators.scope import in_scope
from watchtide.plans import catalog as c
from watchtide.plans import fixtures as fx
from watchtide.plans import jobs
from watchtide.plans import oracle as O
from watchtide.schemas import BRONZE_HEARTBEAT, conform
from watchtide.session import publish, scratch_path
from watchtide.sources.tables import append_table, read_table

LOADERS = ("events", "titles", "dim", "fct_events", "sessions", "fct_sessions")
RUN_DATE = "2024-01-30"
PRICE_KEYS = 7  # price lists: few keys with a version for nearly every day of seven years
MISTAKEN = 0.1  # share of new keys that may pass for seen


class Died(Exception):
    pass


def _dying_after(loader: str):
    def after(done: str) -> None:
        if done == loader:
            raise Died(loader)
    return after


def q_run_day_restarted(spark, sf):
    """Late events and a new title snapshot, and a run that dies after each of its loaders in
    turn before one ends: the mart that an undisturbed run gives."""
    root = scratch_path(spark, "restart")
    cfg = PipelineConfig(root=root, gap_seconds=c.LATE_GAP)
    hb = fx.heartbeats(spark, sf).withColumns({"_unknown_fields": F.lit(None).cast("string"), "_d": F.to_date("event_ts")})
    late = (F.pmod("event_id", F.lit(c.LATE_EVERY)) == 0) & in_scope("_d", *c.LATE)

    def deliver(rows, day, titles, snap):
        rows = rows.withColumns({"_ingest_ts": F.lit(f"{day} 12:00:00").cast("timestamp"), "_ingest_date": F.lit(day).cast("date")})
        append_table(conform(rows, BRONZE_HEARTBEAT), cfg.path("bronze", "playback_heartbeats"), "_ingest_date")
        append_table(c.conform_titles(fx.delivered(titles(spark, sf), snap)), cfg.path("bronze", "dim_title"), "_snapshot_date")

    deliver(hb.filter(~late), "2024-01-29", fx.titles_v1, fx.SNAP_V1)
    jobs.run_day(spark, cfg)
    deliver(hb.filter(late), RUN_DATE, fx.titles_v2, fx.SNAP_V2)
    for loader in LOADERS:
        try:
            jobs.run_day(spark, cfg, processing_date=RUN_DATE, ingest_date=RUN_DATE, after=_dying_after(loader))
        except Died:
            continue
    jobs.run_day(spark, cfg, processing_date=RUN_DATE, ingest_date=RUN_DATE)
    return c.neutral(read_table(spark, cfg.path("gold", "mart_engagement")))


def q_scd2_late_snapshots(spark, sf):
    """Three snapshots delivered last, first, middle: the history that their right order gives."""
    cfg = PipelineConfig(root=scratch_path(spark, "splice"))
    for snap, rows in ((fx.SNAP_V2, fx.titles_v2), (fx.SNAP_V1, fx.titles_v1), (fx.SNAP_MID, fx.titles_mid)):
        append_table(c.conform_titles(fx.delivered(rows(spark, sf), snap)), cfg.path("bronze", "dim_title"), "_snapshot_date")
        jobs.load_titles(spark, cfg)
        jobs.load_dim(spark, cfg)
    return c._dim_out(jobs.read_dim(spark, cfg))


def _loaded(spark, sf):
    """Events loaded so far, and the filters of their ids, written in two parts."""
    target = publish(c._silver(spark, sf).filter(F.col("event_date") <= F.lit(c.LOADED_UNTIL)), "seen-target")
    blocks = publish(blocks_of(target, "event_date"), "seen-blocks")
    odd = F.pmod("event_id", F.lit(2)) == 1
    parts = [filter_rows(target.filter(x), ["event_id"], "event_date", blocks) for x in (odd, ~odd)]
    return target, publish(parts[0].unionByName(parts[1]), "seen-keys")


def q_insert_unseen_events(spark, sf):
    target, seen = _loaded(spark, sf)
    return c.neutral(insert_unseen(target, clean_events(fx.heartbeats_with_replays(spark, sf)), ["event_id"], "event_date", seen))


def q_seen_keys(spark, sf):
    """Per date: rows of a batch, those already loaded, loaded ones that the filter missed (none),
    and whether it takes few of the others for loaded."""
    target, seen = _loaded(spark, sf)
    batch = clean_events(fx.heartbeats_with_replays(spark, sf)).select("event_id", "event_date")
    # keys that were never loaded beside those that were
    batch = batch.unionByName(batch.withColumn("event_id", -F.col("event_id") - 1))
    batch = batch.filter(F.col("event_date") <= F.lit(c.LOADED_UNTIL))
    held = target.select(F.col("event_id").alias("_i"), F.lit(True).alias("_held"))
    flagged = maybe_seen(batch, seen, ["event_id"], "event_date").join(held, F.col("event_id") == F.col("_i"), "left")
    held, maybe = F.col("_held").isNotNull(), F.col("maybe_seen")
    wrong = F.count_if(~held & maybe)
    return flagged.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("batch"), F.count_if(held).alias("loaded"), F.count_if(held & ~maybe).alias("missed"),
        (wrong <= F.lit(5) + F.lit(MISTAKEN) * F.count_if(~held)).alias("within_bound"))


def q_fct_sessions_merged(spark, sf):
    f = asof_merged(c._sessions(spark, sf), c._dim(spark, sf), "title_id", "session_date", ["valid_from"], block_days=7,
                    salts=4, salt_cols=["session_key"])
    return c.neutral(f.select("session_key", "user_id", "title_id", "session_date", F.col("valid_from").alias("version_from")))


def _prices(spark, sf):
    """Price lists over ``lineitem``: a version of a key for each ship date, ended by the next, with
    every 10th missing (a gap)."""
    day = fx.read(spark, sf, "lineitem").select(F.pmod("l_orderkey", F.lit(PRICE_KEYS)).alias("price_key"), F.to_date("l_shipdate").alias("valid_from"),
                                                 "l_partkey")
    v = day.groupBy("price_key", "valid_from").agg(F.min("l_partkey").alias("price"))
    ends = F.lead("valid_from").over(Window.partitionBy("price_key").orderBy("valid_from"))
    v = v.withColumn("valid_to", F.coalesce(ends, F.lit("9999-12-31").cast("date")))
    return v.filter(F.pmod(F.datediff("valid_from", F.lit("1970-01-01").cast("date")), F.lit(10)) != 0)


def q_asof_many_versions(spark, sf):
    """Every order with the price list of its day, some thousands of versions to a key."""
    orders = fx.read(spark, sf, "orders").select("o_orderkey", F.pmod("o_custkey", F.lit(PRICE_KEYS)).alias("price_key"),
                                                  F.to_date("o_orderdate").alias("ordered"))
    out = asof_merged(orders, _prices(spark, sf), "price_key", "ordered", ["price", "valid_from"], block_days=64)
    return out.select("o_orderkey", "price_key", "ordered", "price", "valid_from")


QUERIES = {
    "run_day_restarted": q_run_day_restarted,
    "scd2_late_snapshots": q_scd2_late_snapshots,
    "insert_unseen_events": q_insert_unseen_events,
    "seen_keys": q_seen_keys,
    "fct_sessions_merged": q_fct_sessions_merged,
    "asof_many_versions": q_asof_many_versions,
}

_LATE_SESS = {"srows": O.session_rows("silver", c.LATE_GAP), "sessions": O.session_rollup("srows")}

ORACLE = {
    "run_day_restarted": O.with_ctes(["silver", "dim_once"], {**_LATE_SESS, "f": c._ASOF.replace("JOIN dim d", "JOIN dim_once d")}, c._ENGAGEMENT),
    "scd2_late_snapshots": O.with_ctes(["dim_three"], body=c._DIM_OUT.replace("FROM dim", "FROM dim_three")),
    "insert_unseen_events": c.ORACLE["insert_new_events"],
    "seen_keys": O.with_ctes(["silver", "silver2"], {"batch": f"""
SELECT event_id, event_date FROM silver2 WHERE event_date <= DATE '{c.LOADED_UNTIL}'
UNION ALL SELECT -event_id - 1, event_date FROM silver2 WHERE event_date <= DATE '{c.LOADED_UNTIL}'"""}, f"""
SELECT b.event_date, COUNT(*) AS batch, COUNT(t.event_id) AS loaded, CAST(0 AS BIGINT) AS missed, true AS within_bound
FROM batch b LEFT JOIN (SELECT event_id FROM silver WHERE event_date <= DATE '{c.LOADED_UNTIL}') t USING (event_id)
GROUP BY b.event_date"""),
    "fct_sessions_merged": c.ORACLE["fct_sessions_salted"],
    "asof_many_versions": f"""
WITH v AS (SELECT l_orderkey % {PRICE_KEYS} AS price_key, CAST(l_shipdate AS DATE) AS valid_from, MIN(l_partkey) AS price FROM lineitem GROUP BY ALL),
     w AS (SELECT *, coalesce(lead(valid_from) OVER (PARTITION BY price_key ORDER BY valid_from), DATE '9999-12-31') AS valid_to FROM v),
     x AS (SELECT * FROM w WHERE date_diff('day', DATE '1970-01-01', valid_from) % 10 <> 0),
     o AS (SELECT o_orderkey, o_custkey % {PRICE_KEYS} AS price_key, CAST(o_orderdate AS DATE) AS ordered FROM orders)
SELECT o.o_orderkey, o.price_key, o.ordered, x.price, x.valid_from
FROM o LEFT JOIN x ON o.price_key = x.price_key AND o.ordered >= x.valid_from AND o.ordered < x.valid_to""",
}
