"""Dedup, rescued rows, insert-only merge and scoped replacement."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from watchtide.operators.clean import clean_events, dedup_latest, ingest_day
from watchtide.operators.merge import insert_new
from watchtide.operators.scope import date_ranges, days_between, in_scope, replace_scope, window_for

SCHEMA = ("event_id long, user_id long, title_id int, playback_position_sec int, "
          "bitrate_kbps int, is_rebuffering boolean, country_code string, cdn_pop string, "
          "event_ts timestamp, session_id string, "
          "device struct<device_type:string,device_os:string>, "
          "_ingest_ts timestamp, _source_file string, _rescued_data string")


def hb(spark, specs):
    """specs: (event_id, title_id, event_ts, ingest_ts, rescued, position)."""
    data = [(e, 1, t, pos, 480, False, "US", "iad", ts, "s", ("tv", "os"), ing, "f", r)
            for e, t, ts, ing, r, pos in specs]
    return spark.createDataFrame(data, SCHEMA)


D = dt.datetime


def test_latest_copy_wins(spark):
    df = hb(spark, [(1, 5, D(2024, 1, 1), D(2024, 1, 2), None, 10),
                    (1, 5, D(2024, 1, 1), D(2024, 1, 3), None, 11)])
    out = clean_events(df)
    assert rows(out, "event_id", "playback_position_sec") == [(1, 11)]
    assert out.columns == ["event_id", "user_id", "title_id", "playback_position_sec",
                           "bitrate_kbps", "is_rebuffering", "country_code", "cdn_pop",
                           "event_ts", "event_date", "device_type", "device_os"]


def test_rescued_latest_copy(spark):
    df = hb(spark, [(1, 5, D(2024, 1, 1), D(2024, 1, 2), None, 10),
                    (1, 5, D(2024, 1, 1), D(2024, 1, 3), "bad", 11)])
    assert clean_events(df).count() == 0  # reference order: the event is lost
    assert rows(clean_events(df, filter_first=True), "playback_position_sec") == [(10,)]


def test_not_null_guards(spark):
    df = hb(spark, [(1, None, D(2024, 1, 1), D(2024, 1, 2), None, 1),
                    (2, 5, None, D(2024, 1, 2), None, 1)])
    assert clean_events(df).count() == 0


def test_dedup_hot_key_is_limited_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    out = dedup_latest(df, ["k"], ["v"])
    assert rows(out) == [(0, 998), (1, 999)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_insert_new_keys_and_nulls(spark):
    t = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 1))],
                              "event_id long, event_date date")
    s = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (1, dt.date(2024, 1, 2)),
                               (None, dt.date(2024, 1, 1)), (3, dt.date(2024, 1, 1))],
                              "event_id long, event_date date")
    out = rows(insert_new(t, s, ["event_id", "event_date"]))
    assert out == [(1, dt.date(2024, 1, 2)), (3, dt.date(2024, 1, 1)),
                   (None, dt.date(2024, 1, 1))]
    pruned = rows(insert_new(t, s, ["event_id", "event_date"], prune_col="event_date"))
    assert pruned == out


def test_replace_scope_clears_ghosts(spark):
    old = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 2)),
                                 ("c", dt.date(2024, 1, 3)), ("n", None)], "k string, d date")
    new = spark.createDataFrame([("c2", dt.date(2024, 1, 3))], "k string, d date")
    out = rows(replace_scope(old, new, in_scope("d", "2024-01-02", "2024-01-03")), "k")
    assert out == [("a",), ("c2",), ("n",)]


def test_window_and_ingest_day(spark):
    assert window_for("2024-02-01", 2) == ("2024-01-30", "2024-02-01")
    df = spark.createDataFrame([(D(2024, 1, 1, 23, 59),), (D(2024, 1, 2),), (D(2024, 1, 2, 23),),
                                (D(2024, 1, 3),)], "_ingest_ts timestamp")
    assert ingest_day(df, "2024-01-02").count() == 2


def test_good_copy_behind_a_bad_one_and_the_reverse(spark):
    df = hb(spark, [(1, 5, D(2024, 1, 1), D(2024, 1, 2), "bad", 10), (1, 5, D(2024, 1, 1), D(2024, 1, 3), None, 11),
                    (2, 5, D(2024, 1, 1), D(2024, 1, 2), None, 20), (2, 5, D(2024, 1, 1), D(2024, 1, 3), "bad", 21)])
    assert rows(clean_events(df), "event_id", "playback_position_sec") == [(1, 11)]
    assert rows(clean_events(df, filter_first=True), "event_id", "playback_position_sec") == [(1, 11), (2, 20)]


def test_date_ranges():
    assert date_ranges(["2024-01-03", "2024-01-01", "2024-01-02", "2024-01-08"]) == [("2024-01-01", "2024-01-03"), ("2024-01-08", "2024-01-08")]
    assert date_ranges(["2024-01-01", "2024-01-04"], join_days=2) == [("2024-01-01", "2024-01-04")]
    assert date_ranges([]) == [] and days_between("2024-02-28", "2024-03-01") == ["2024-02-28", "2024-02-29", "2024-03-01"]
