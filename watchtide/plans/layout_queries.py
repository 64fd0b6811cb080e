"""Queries over layouts, exact and frequent counts that merge, and sessions in two levels."""

from __future__ import annotations

import uuid

from pyspark.sql import Observation
from pyspark.sql import functions as F

from watchtide.operators import distinct as D
from watchtide.operators.clean import date_window
from watchtide.operators.joins import enrich_current
from watchtide.operators.layout import lookup_cost
from watchtide.operators.sessions import rollup_sessions, rollup_sessions_by_day
from watchtide.plans import catalog as c
from watchtide.session import publish, scratch_path
from watchtide.sources.tables import (append_table, cluster_curve_table, compact_small, read_table, run_noop, write_bucketed, write_table)

CURVE = ["event_date", "title_id", "user_id"]
FILES, BUCKETS = 8, 8
JOIN_KEYS = ["user_id", "title_id"]


def q_curve_layout(spark, sf):
    """Per column: its values, and whether a lookup of one touches fewer files and a smaller share of
    the bytes of a table laid along a curve through three columns than of one laid as it comes."""
    root = scratch_path(spark, "curve")
    write_table(c._silver(spark, sf).repartition(FILES), f"{root}/plain")
    cluster_curve_table(spark, f"{root}/plain", f"{root}/curve", CURVE, FILES)
    plain, curve = (spark.read.parquet(f"{root}/{x}") for x in ("plain", "curve"))
    out = None
    for col in CURVE:
        share = F.col("read_bytes") / F.col("bytes")
        was = lookup_cost(plain, col).select(F.col("touched").alias("_t"), share.alias("_b"))
        n = plain.agg(F.count_distinct(col).alias("values"))
        one = (lookup_cost(curve, col).join(was).join(n).select(
            F.lit(col).alias("column"), "values", (F.col("touched") < F.col("_t")).alias("fewer_files"), (share < F.col("_b")).alias("fewer_bytes")))
        out = one if out is None else out.unionByName(one)
    return out


def bucketed_join(spark, events, sessions):
    """``join_big_big`` over two tables in equal buckets: no side moves or is sorted."""
    root, name = scratch_path(spark, "buckets"), f"b{uuid.uuid4().hex[:12]}"
    ev = write_bucketed(events.select("event_id", *JOIN_KEYS, "event_ts"), f"{name}_events", f"{root}/events", JOIN_KEYS, BUCKETS)
    se = write_bucketed(sessions.select("session_key", *JOIN_KEYS, "session_start", "session_end"), f"{name}_sessions", f"{root}/sessions", JOIN_KEYS, BUCKETS)
    return c.join_big_big(ev, se)


def q_join_bucketed(spark, sf):
    ev = c._hot(spark, sf)
    return bucketed_join(spark, ev, rollup_sessions(ev, gap_seconds=c.LATE_GAP, key="start"))


def q_compact_selective(spark, sf):
    """Even days come in small files, odd days don't. Compacted twice: files per day, and whether they are new."""
    path = f"{scratch_path(spark, 'small')}/events"
    silver = publish(c._silver(spark, sf), "small-events")
    even = F.pmod(F.dayofmonth("event_date"), F.lit(2)) == 0
    silver.filter(even).repartition(6).write.partitionBy("event_date").parquet(path)
    append_table(silver.filter(~even), path, "event_date")
    files = lambda: spark.read.parquet(path).select("event_date", F.col("_metadata.file_path").alias("f"))
    before = publish(files().distinct(), "small-before").select(F.col("f").alias("_f"))
    first = compact_small(spark, path, "event_date")
    again = compact_small(spark, path, "event_date")
    after = files().join(before, F.col("f") == F.col("_f"), "left").groupBy("event_date").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("f").alias("files_after"), F.bool_or(F.col("_f").isNull()).alias("rewritten"))
    listed = F.col("event_date").cast("string").isin(first) if first else F.lit(False)
    return after.withColumns({"listed": listed, "left_alone": F.lit(not again)})


def q_distinct_bitmaps(spark, sf):
    """Bitmaps of users per title, country and day, merged over the days."""
    ev = c._silver(spark, sf)
    first = publish(D.dense_ids(ev.filter(F.pmod("user_id", F.lit(2)) == 0), "user_id"), "users")
    ids = publish(D.dense_ids(ev, "user_id", known=first), "users")
    daily = publish(D.distinct_bitmaps(ev, [*D.GROUP, "event_date"], ids=ids), "user-bits")
    return D.count_bitmaps(D.merge_bitmaps(daily, D.GROUP), D.GROUP)


def q_dense_ids(spark, sf):
    """How the dictionary of users looks: as many ids as users, from 0 on, none twice."""
    ev = c._silver(spark, sf)
    first = publish(D.dense_ids(ev.filter(F.pmod("user_id", F.lit(2)) == 0), "user_id"), "users")
    ids = D.dense_ids(ev, "user_id", known=first)
    return ids.agg(F.count(F.lit(1)).alias("users"), F.count_distinct("id").alias("ids"), F.min("id").alias("least"), F.max("id").alias("greatest"))


def q_frequent_titles(spark, sf):
    """Titles with over 5 % of the rows from sketches of each day, combined."""
    ev = c._hot(spark, sf)
    daily = publish(D.frequent_sketch(ev, "title_id", ["event_date"]), "sketches")
    n = ev.agg(F.count(F.lit(1))).scalar()
    return D.frequent_keys(daily, "title_id").filter(F.col("n") > F.lit(c.HOT_FRACTION) * n)


def q_join_salted_sketch(spark, sf):
    """The salted join with hot keys from a sketch instead of a count of every key."""
    events, dim = c.join_inputs(spark, sf)
    n = events.agg(F.count(F.lit(1))).scalar()
    hot = D.frequent_keys(D.frequent_sketch(events, "title_id"), "title_id").filter(F.col("n") > F.lit(c.HOT_FRACTION) * n).select("title_id")
    return enrich_current(events, dim, "title_id", strategy="salted", hot=hot).select("event_id", "title_id", "user_id", "title_name", "content_type", "runtime_min")


def q_sessions_by_day(spark, sf):
    return c.neutral(rollup_sessions_by_day(c._silver(spark, sf), gap_seconds=c.SESSION_GAP))


def q_sessions_hot_title_by_day(spark, sf):
    return c.neutral(rollup_sessions_by_day(c._hot(spark, sf), keys=("title_id",)))


def q_noop_sink(spark, sf):
    """Rows and event dates that the noop sink was handed."""
    obs = Observation("noop")
    run_noop(c._silver(spark, sf).observe(obs, F.count(F.lit(1)).alias("events"), F.max("event_date").alias("last")))
    return spark.createDataFrame([(obs.get["events"], obs.get["last"])], "events long, last date")


def q_pruned_read(spark, sf):
    """Three days of a table partitioned by day, with the folders that were read."""
    path = f"{scratch_path(spark, 'pruned')}/events"
    append_table(c._silver(spark, sf), path, "event_date")
    t = date_window(read_table(spark, path), "event_date", *c.LATE)
    day = F.regexp_extract(F.col("_metadata.file_path"), r"event_date=([0-9-]+)", 1)
    return t.select("event_date", day.alias("folder")).groupBy("event_date", "folder").agg(F.count(F.lit(1)).alias("events"))


QUERIES = {
    "curve_layout": q_curve_layout,
    "join_bucketed": q_join_bucketed,
    "compact_selective": q_compact_selective,
    "distinct_bitmaps": q_distinct_bitmaps,
    "dense_ids": q_dense_ids,
    "frequent_titles": q_frequent_titles,
    "join_salted_sketch": q_join_salted_sketch,
    "sessions_by_day": q_sessions_by_day,
    "sessions_hot_title_by_day": q_sessions_hot_title_by_day,
    "noop_sink": q_noop_sink,
    "pruned_read": q_pruned_read,
}

ORACLE = {
    "curve_layout": c.O.with_ctes(["silver"], body="\nUNION ALL\n".join(
        f"SELECT '{x}' AS \"column\", COUNT(DISTINCT {x}) AS \"values\", true AS fewer_files, true AS fewer_bytes FROM silver" for x in CURVE)),
    "join_bucketed": c.ORACLE["join_big_big"],
    "compact_selective": c.O.with_ctes(["silver"], body="""
SELECT event_date, COUNT(*) AS events, CAST(1 AS BIGINT) AS files_after, day(event_date) % 2 = 0 AS rewritten,
       day(event_date) % 2 = 0 AS listed, true AS left_alone FROM silver GROUP BY event_date"""),
    "distinct_bitmaps": c.ORACLE["distinct_exact"],
    "dense_ids": c.O.with_ctes(["silver"], body="""
SELECT COUNT(DISTINCT user_id) AS users, COUNT(DISTINCT user_id) AS ids, CAST(0 AS BIGINT) AS least,
       COUNT(DISTINCT user_id) - 1 AS greatest FROM silver"""),
    "frequent_titles": c.ORACLE["heavy_hitters"],
    "join_salted_sketch": c.ORACLE["join_salted"],
    "sessions_by_day": c.ORACLE["sessions"],
    "sessions_hot_title_by_day": c.ORACLE["sessions_hot_title"],
    "noop_sink": c.O.with_ctes(["silver"], body="SELECT COUNT(*) AS events, MAX(event_date) AS last FROM silver"),
    "pruned_read": c.O.with_ctes(["silver"], body=f"""
SELECT event_date, CAST(event_date AS VARCHAR) AS folder, COUNT(*) AS events FROM silver
WHERE event_date BETWEEN DATE '{c.LATE[0]}' AND DATE '{c.LATE[1]}' GROUP BY event_date"""),
}
