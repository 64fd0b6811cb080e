"""Plan shape: exchanges, map-side work, pushdown/pruning, join nodes."""

import datetime as dt

from pyspark.sql import functions as F

from watchtide.operators.clean import date_window
from watchtide.operators.marts import mart_qos
from watchtide.operators.sessions import rollup_sessions, sessionize


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def events(spark, path):
    df = spark.range(2000).select(
        F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"),
        (F.col("id") % 3).cast("int").alias("title_id"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                             F.col("id") * 97)).alias("event_ts"),
        F.lit(100).alias("playback_position_sec"), F.lit(480).alias("bitrate_kbps"),
        F.lit(False).alias("is_rebuffering"), F.lit("US").alias("country_code"),
        F.lit("iad").alias("cdn_pop"), F.lit("tv").alias("device_type"),
        F.lit("x").alias("unused_wide_column"))
    df = df.withColumn("event_date", F.to_date("event_ts"))
    df.write.mode("overwrite").partitionBy("event_date").parquet(path)
    return spark.read.parquet(path)


def test_single_window_sessionize_has_one_exchange(spark, tmp_dir):
    ev = events(spark, f"{tmp_dir}/ev")
    p = plan(sessionize(ev, gap_seconds=1800, by_second=False))
    assert p.count("Exchange hashpartitioning") == 1


def test_rollup_sums_events_before_the_first_exchange(spark, tmp_dir):
    p = plan(rollup_sessions(events(spark, f"{tmp_dir}/ev"), gap_seconds=1800))
    assert p.count("Exchange hashpartitioning") == 2
    below = p[p.rindex("Exchange hashpartitioning"):]  # the plan is printed from the top
    assert "partial_min(event_ts" in below and "Window" not in below


def test_sessionize_moves_rows_once(spark, tmp_dir):
    ev = events(spark, f"{tmp_dir}/ev").hint("merge")
    p = plan(sessionize(ev, gap_seconds=1800))
    moved = [x for x in p.split("Exchange hashpartitioning")[1:] if "playback_position_sec" in x.split("FileScan")[0]]
    assert len(moved) <= 1


def test_qos_mart_partial_aggregation_and_pruned_scan(spark, tmp_dir):
    ev = events(spark, f"{tmp_dir}/ev")
    p = plan(mart_qos(date_window(ev, "event_date", "2024-01-01", "2024-01-01")))
    assert p.count("HashAggregate") == 2 and p.count("Exchange hashpartitioning") == 1
    assert "PartitionFilters: [isnotnull(event_date" in p
    assert "unused_wide_column" not in p.split("ReadSchema:")[1].split("\n")[0]


def test_facts_and_marts_have_no_single_task_and_start_no_job(spark):
    from watchtide.operators.marts import fct_sessions, mart_engagement
    fact = spark.range(100).select(
        F.col("id").cast("string").alias("session_key"), F.col("id").alias("user_id"), F.col("id").cast("int").alias("title_id"),
        F.lit(dt.date(2024, 1, 5)).alias("session_date"), F.lit(1).cast("long").alias("heartbeats"), F.lit(5).alias("max_position_sec"),
        F.lit("US").alias("country_code"), F.lit("tv").alias("device_type"), F.lit(1.0).alias("avg_bitrate"),
        F.lit(0).cast("long").alias("rebuffer_events"), F.lit(dt.datetime(2024, 1, 5)).alias("session_start"), F.lit(dt.datetime(2024, 1, 5)).alias("session_end"))
    dim = spark.range(10).select(F.col("id").alias("title_id"), F.col("id").alias("title_sk"), F.array(F.lit("a")).alias("genres"),
                                 F.lit(10).alias("runtime_min"), F.lit(dt.date(2024, 1, 1)).alias("valid_from"),
                                 F.lit(dt.date(9999, 12, 31)).alias("valid_to"))
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    facts = fct_sessions(fact, dim)
    for p in (plan(facts), plan(mart_engagement(facts, dim))):
        assert "SinglePartition" not in p
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before


def test_exact_and_sketched_distincts_are_apart(spark):
    from watchtide.operators.distinct import distinct_error
    df = spark.range(100).select((F.col("id") % 3).alias("title_id"), F.lit("US").alias("country_code"), F.col("id").alias("user_id"))
    p = distinct_error(df)._jdf.queryExecution().toString()
    for line in p.split("\n"):
        if "approx_count_distinct" in line and "keys=[" in line:
            assert "user_id" not in line.split("keys=[")[1].split("]")[0]


def test_closed_versions_stay_out_of_the_scd2_join(spark):
    from watchtide.operators.scd2 import empty_dim, scd2_apply
    snap = spark.createDataFrame([], "title_id long, title_name string, genres array<string>, content_type string, release_year int, runtime_min int")
    p = scd2_apply(empty_dim(spark), snap, "2024-01-01")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in p or "LocalRelation" in p
