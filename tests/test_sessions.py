"""Sessionization boundary semantics (gap on floored seconds, ties, NULL keys), equality of
the by-second and single-window plans, and scopes rebuilt across midnight."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import rows
from watchtide.operators.sessions import rollup_sessions, rows_of_keys, scoped_sessions, sessionize

BASE = dt.datetime(2024, 1, 1)


def events(spark, specs):
    """specs: (event_id, user, title, seconds_after_base)."""
    data = [(i, u, t, BASE + dt.timedelta(seconds=s), 100, 480, False, "US", "smart_tv")
            for i, u, t, s in specs]
    return spark.createDataFrame(
        data, "event_id long, user_id long, title_id int, event_ts timestamp, "
              "playback_position_sec int, bitrate_kbps int, is_rebuffering boolean, "
              "country_code string, device_type string")


@pytest.mark.parametrize("by_second", [False, True])
def test_gap_boundary(spark, by_second):
    df = events(spark, [(1, 1, 1, 0), (2, 1, 1, 1800), (3, 1, 1, 3601), (4, 1, 1, 3601)])
    out = rows(sessionize(df, gap_seconds=1800, by_second=by_second), "event_id", "session_num")
    assert out == [(1, 0), (2, 0), (3, 1), (4, 1)]


@pytest.mark.parametrize("by_second", [False, True])
def test_fractional_seconds_use_floors(spark, by_second):
    df = events(spark, [(1, 1, 1, 0.9), (2, 1, 1, 1801.0), (3, 2, 1, 0.0), (4, 2, 1, 1800.9)])
    out = rows(sessionize(df, gap_seconds=1800, by_second=by_second), "event_id", "session_num")
    assert out == [(1, 0), (2, 1), (3, 0), (4, 0)]


def test_first_index_dataframe_variant(spark):
    df = events(spark, [(1, 1, 1, 0), (2, 1, 1, 5000)])
    out = rows(sessionize(df, gap_seconds=1800, first_index=1), "event_id", "session_num")
    assert out == [(1, 1), (2, 2)]


@pytest.mark.parametrize("by_second", [False, True])
def test_null_user_key_and_rollup(spark, by_second):
    df = events(spark, [(1, None, 5, 0), (2, None, 5, 10), (3, None, 5, 9000)])
    s = rollup_sessions(df, gap_seconds=1800, by_second=by_second)
    out = rows(s, "session_key", "heartbeats", "watch_seconds")
    assert out == [("5_0", 2, 20), ("5_1", 1, 10)]


def test_rollup_columns(spark):
    df = events(spark, [(1, 7, 3, 0), (2, 7, 3, 60)])
    s = rollup_sessions(df, gap_seconds=1800)
    assert s.columns == ["session_key", "user_id", "title_id", "session_start", "session_end",
                         "session_date", "heartbeats", "max_position_sec", "rebuffer_events",
                         "avg_bitrate", "country_code", "device_type", "watch_seconds"]
    r = s.first()
    assert r.session_key == "7_3_0" and r.heartbeats == 2 and r.avg_bitrate == 480.0


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 40000)),
                min_size=1, max_size=60), st.booleans())
def test_by_second_equals_single_window(spark, specs, nulls):
    df = events(spark, [(i, None if nulls and u == 0 else u, t, s / 4) for i, (u, t, s) in enumerate(specs)])
    a = rows(rollup_sessions(df, gap_seconds=1800, by_second=False))
    assert a == rows(rollup_sessions(df, gap_seconds=1800))
    c = rows(sessionize(df, gap_seconds=1800, by_second=False), "event_id", "session_num")
    assert c == rows(sessionize(df, gap_seconds=1800), "event_id", "session_num")


def dated(spark, specs):
    from pyspark.sql import functions as F
    return events(spark, specs).withColumn("event_date", F.to_date("event_ts"))


HOUR = 3600


def test_a_session_across_midnight_is_one_row_of_its_first_day(spark):
    """23:50 to 00:15 over the lower edge of the scope: not cut, and counted once."""
    df = dated(spark, [(1, 1, 1, 48 * HOUR - 600), (2, 1, 1, 48 * HOUR + 60), (3, 1, 1, 48 * HOUR + 900), (4, 2, 1, 49 * HOUR)])
    inside, beyond, scope = scoped_sessions(df, "2024-01-03", "2024-01-03")
    assert scope == ("2024-01-02", "2024-01-04") and beyond.isEmpty()
    assert rows(inside, "user_id", "heartbeats", "session_date") == [(1, 3, dt.date(2024, 1, 2)), (2, 1, dt.date(2024, 1, 3))]


def test_a_chain_of_days_asks_for_a_wider_scope(spark):
    df = dated(spark, [(i, 1, 1, i * 1500) for i in range(60 * 24 * 5 // 25)])  # five days without a gap
    _, beyond, _ = scoped_sessions(df, "2024-01-03", "2024-01-03")
    assert not beyond.isEmpty()
    inside, beyond, _ = scoped_sessions(df, "2024-01-03", "2024-01-03", pad_days=4)
    assert beyond.isEmpty() and rows(inside, "heartbeats") == [(288,)]


def test_only_what_may_go_on_unread_asks_for_a_wider_scope(spark):
    """The last day read is the 5th: a session that is over by its noon is whole, one of its last half hour may not be."""
    over = dated(spark, [(i, 1, 1, 95 * HOUR + i * 1500) for i in range(30)])  # from the 4th to noon of the 5th
    inside, beyond, _ = scoped_sessions(over, "2024-01-03", "2024-01-03")
    assert beyond.isEmpty() and rows(inside, "heartbeats") == [(30,)]
    late = dated(spark, [(i, 1, 1, 95 * HOUR + i * 1500) for i in range(60)])  # to the end of the 5th, where reading ends
    assert not scoped_sessions(late, "2024-01-03", "2024-01-03")[1].isEmpty()


def test_a_gap_of_days_that_reaches_what_is_unread(spark):
    """Read up to the 7th: the session's next event comes on the 8th, 40 hours after its last one that is read."""
    df = dated(spark, [(1, 1, 1, 72 * HOUR), (2, 1, 1, 118 * HOUR), (3, 1, 1, 130 * HOUR), (4, 1, 1, 170 * HOUR)])
    assert not scoped_sessions(df, "2024-01-03", "2024-01-03", gap_seconds=48 * HOUR)[1].isEmpty()


def test_rows_of_keys_take_null_for_a_key(spark):
    df = events(spark, [(1, 1, 1, 0), (2, None, 1, 0), (3, 2, 1, 0)])
    keys = df.filter("event_id < 3").select("user_id", "title_id")
    assert rows(rows_of_keys(df, keys), "event_id") == [(1,), (2,)]


def test_key_by_start_does_not_depend_on_what_is_read(spark):
    df = dated(spark, [(1, 1, 1, 0), (2, 1, 1, 5 * HOUR), (3, 1, 1, 9 * HOUR)])
    full = {r.session_start: r.session_key for r in rollup_sessions(df, key="start").collect()}
    part = {r.session_start: r.session_key for r in rollup_sessions(df.filter("event_id > 1"), key="start").collect()}
    assert part.items() <= full.items() and len(full) == 3


def test_heartbeats_sum_to_events(spark):
    df = events(spark, [(i, i % 3, i % 2, i * 700) for i in range(50)])
    s = rollup_sessions(df, gap_seconds=1800)
    assert s.agg({"heartbeats": "sum"}).first()[0] == 50
