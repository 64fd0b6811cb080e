"""As-of join edges, join strategies agree, broadcast size check, mart edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from watchtide.operators.distinct import heavy_hitters
from watchtide.operators.joins import asof_dim_join, broadcast_if_small, enrich_current, salted_join
from watchtide.operators.marts import mart_engagement

DIM = ("title_sk long, title_id long, genres array<string>, runtime_min int, "
       "valid_from date, valid_to date, is_current boolean")
d = dt.date.fromisoformat


@pytest.fixture()
def dim(spark):
    return spark.createDataFrame([
        (10, 1, ["a", "b"], 100, d("2024-01-01"), d("2024-01-16"), False),
        (11, 1, ["a"], 0, d("2024-01-16"), d("9999-12-31"), True),
        (20, 2, [], 50, d("2024-01-01"), d("9999-12-31"), True),
        (30, 3, None, None, d("2024-01-01"), d("9999-12-31"), True),
    ], DIM)


@pytest.mark.parametrize("strategy", ["broadcast", "merge", "auto", "salted"])
def test_asof_edges(spark, dim, strategy):
    f = spark.createDataFrame([(1, 1, d("2024-01-15")), (2, 1, d("2024-01-16")),
                               (3, 1, d("2023-12-31")), (4, 9, d("2024-01-20"))],
                              "sid int, title_id int, session_date date")
    out = rows(asof_dim_join(f, dim, strategy=strategy, salt_cols=["sid"]), "sid", "title_sk")
    assert out == [(1, 10), (2, 11), (3, None), (4, None)]


def test_join_strategies_agree(spark, dim):
    ev = spark.range(2000).select(F.col("id").alias("event_id"),
                                  F.when(F.col("id") < 1500, 1).otherwise(F.col("id") % 3 + 1)
                                  .cast("long").alias("title_id"))
    cur = dim.filter("is_current").select("title_id", "title_sk")
    want = rows(ev.join(cur, "title_id"))
    for strategy in ["merge", "broadcast", "auto"]:
        assert rows(enrich_current(ev, cur, strategy=strategy)) == want
    assert rows(enrich_current(ev, cur, strategy="salted")) == want
    hot = heavy_hitters(ev, "title_id", 1000).select("title_id")
    assert rows(hot) == [(1,)]  # one key is hot, two are cold
    assert rows(enrich_current(ev, cur, strategy="salted", hot=hot, n=4)) == want
    assert rows(enrich_current(ev, cur, strategy="salted", hot=hot.limit(0))) == want


def test_rows_without_a_key_are_spread_and_kept(spark, dim):
    ev = spark.range(400).select(F.col("id").alias("event_id"), F.when(F.col("id") % 4 == 0, 1).cast("long").alias("title_id"))
    cur = dim.filter("is_current").select("title_id", "title_sk")
    out = salted_join(ev, cur, "title_id", ["event_id"], hot=heavy_hitters(ev, "title_id", 1000).select("title_id"), how="left")
    assert out.count() == 400 and out.filter("title_sk IS NULL").count() == 300


def test_only_known_small_sides_get_a_hint(spark, dim, tmp_dir):
    dim.write.parquet(f"{tmp_dir}/dim")
    table = spark.read.parquet(f"{tmp_dir}/dim")
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(table)) and not hinted(broadcast_if_small(table, max_bytes=10))


def test_engagement_completion_and_genres(spark, dim):
    fct = spark.createDataFrame([
        (11, d("2024-01-20"), "US", 1, 6, 500),   # runtime 0 -> completion 1.0
        (30, d("2024-01-20"), "US", 2, 6, 10),    # NULL genres -> vanishes
        (20, d("2024-01-20"), "US", 3, 6, 10),    # empty genres -> vanishes
        (10, d("2024-01-10"), "BR", 4, 360, 9000),  # capped at 1.0, counted per genre
        (None, d("2024-01-10"), "BR", 5, 1, 1),   # no version -> dropped by inner join
    ], "title_sk long, session_date date, country_code string, user_id long, heartbeats long, "
       "max_position_sec int")
    out = rows(mart_engagement(fct, dim).select(
        "session_date", "genre", "country_code", "total_sessions", "distinct_users",
        F.col("watch_hours").cast("double"), F.col("avg_completion").cast("double")))
    assert out == [(d("2024-01-10"), "a", "BR", 1, 1, 1.0, 1.0),
                   (d("2024-01-10"), "b", "BR", 1, 1, 1.0, 1.0),
                   (d("2024-01-20"), "a", "US", 1, 1, 0.02, 1.0)]
