"""Sessions in two levels, counts that merge, curves, buckets, compaction, one reading of the landing files."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF001, rows
from test_plans import events, plan
from watchtide.operators import distinct as D
from watchtide.operators.layout import lookup_cost, rank_bounds, with_curve
from watchtide.operators.sessions import rollup_sessions, rollup_sessions_by_day
from watchtide.plans import catalog as c
from watchtide.plans.layout_queries import bucketed_join
from watchtide.session import publish
from watchtide.sources import files
from watchtide.sources.tables import cluster_curve_table, compact_small, data_files
from watchtide.streaming import bronze


def _seconds(spark, seconds):
    base = dt.datetime(2024, 1, 1)
    data = [(i, k, 1, None if s is None else base + dt.timedelta(seconds=s), i % 7, 480 + i, False, "US", f"d{i}") for i, (k, s) in enumerate(seconds)]
    return spark.createDataFrame(data, "event_id long, user_id long, title_id int, event_ts timestamp, playback_position_sec int, "
                                       "bitrate_kbps int, is_rebuffering boolean, country_code string, device_type string")


@pytest.mark.parametrize("gap", [1800, 90_000, 400_000])
@pytest.mark.parametrize("key", ["number", "start"])
def test_two_levels_equal_one_window(spark, gap, key):
    day = 86_400
    ev = _seconds(spark, [(1, s) for s in (-5, 0, 10, day - 1, day, day + 1, 2 * day + 1799, 3 * day, 3 * day, 9 * day, 9 * day + 1801)]
                  + [(2, d * day + 7) for d in range(30)] + [(3, 1000 * i) for i in range(400)] + [(None, 5), (None, day + 5), (4, None), (4, 50)])
    assert rows(rollup_sessions_by_day(ev, gap_seconds=gap, key=key)) == rows(rollup_sessions(ev, gap_seconds=gap, key=key))


def test_no_window_by_key_alone_over_seconds(spark, tmp_dir):
    p = plan(rollup_sessions_by_day(events(spark, f"{tmp_dir}/ev")))
    windows = [line for line in p.split("\n") if "Window " in line or "Window [" in line]
    over_days = [w for w in windows if "_day#" not in w.split("],")[1]] if windows else []
    assert windows and all("_sec#" not in w and "event_ts" not in w for w in over_days)


def test_dictionary_ids_have_no_gaps_and_stay(spark):
    v = spark.createDataFrame([(f"u{i % 500}",) for i in range(2000)] + [(None,)], "u string")
    first = D.dense_ids(v.filter("u < 'u3'"), "u", parts=16).cache()
    every = D.dense_ids(v, "u", known=first, parts=16)
    ids = {r.value: r.id for r in every.collect()}
    assert sorted(ids.values()) == list(range(500)) and all(ids[r.value] == r.id for r in first.collect())
    assert D.dense_ids(v.limit(0), "u").count() == 0


def test_bitmaps_are_exact_after_merging_and_count_rows_without_a_user(spark):
    df = spark.range(200_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 10).alias("day"),
                                     F.when(F.col("id") % 100 != 0, F.col("id") * 7 % 90_001).alias("u"))
    daily = D.distinct_bitmaps(df, ["g", "day"], "u")
    assert daily.filter("bucket IS NOT NULL").select("bucket").distinct().count() == 4  # bucket 0 holds id 0 alone
    got = rows(D.count_bitmaps(D.merge_bitmaps(daily, ["g"]), ["g"]))
    assert got == rows(df.groupBy("g").agg(F.count_distinct("u").alias("distinct_users"), F.count(F.lit(1)).alias("events")))


def test_frequent_keys_of_merged_sketches(spark):
    """Recall of the most frequent of 20,000 keys, with room for 2,048, and the error's bound."""
    n, room = 300_000, 2048
    df = spark.range(n).select(F.floor(F.pow(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1e6, 6) * 20_000).cast("long").alias("k"), (F.col("id") % 5).alias("day"))
    exact = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    top = sorted(exact, key=lambda k: -exact[k])[:20]
    got = {r.k: r.n for r in D.frequent_keys(D.frequent_sketch(df, "k", ["day"], items=room), "k", k=60, items=room).collect()}
    assert len(set(top) & set(got)) >= 19
    assert all(abs(n_ - exact[k]) <= 4 * n / room for k, n_ in got.items())


def test_curve_serves_every_column(spark, tmp_dir):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("a"), (F.col("id") * 104_729 % 19_997).alias("b"),
                                    F.expr("date_add(DATE'2024-01-01', int(id * 31 % 1000))").alias("d"))
    df.repartition(16).write.parquet(f"{tmp_dir}/plain")
    cluster_curve_table(spark, f"{tmp_dir}/plain", f"{tmp_dir}/curve", ["a", "b", "d"], 16)
    cost = lambda name, col: lookup_cost(spark.read.parquet(f"{tmp_dir}/{name}"), col).first()
    for col in ("a", "b", "d"):
        was, now = cost("plain", col), cost("curve", col)
        assert was.files == now.files == 16 and was.touched > 15
        assert now.touched < 12 and now.read_bytes < 0.75 * was.read_bytes
    assert rows(spark.read.parquet(f"{tmp_dir}/curve")) == rows(df)


def test_lookup_cost_counts_files_that_can_hold_a_value(spark, tmp_dir):
    for i, (lo, hi) in enumerate([(0, 10), (5, 20), (30, 30)]):
        spark.range(lo, hi + 1).select(F.col("id").alias("v")).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/t")
    values = [*range(0, 21), 30]
    touched = sum((0 <= v <= 10) + (5 <= v <= 20) + (v == 30) for v in values) / len(values)
    got = lookup_cost(spark.read.parquet(f"{tmp_dir}/t"), "v").first()
    assert (got.files, got.touched) == (3, touched)


def test_curve_interleaves_the_bits_of_ranks(spark):
    df = spark.range(16).select(F.col("id").alias("a"), (15 - F.col("id")).alias("b"))
    bounds = {"a": [4, 8, 12], "b": [4, 8, 12]}
    got = {r.a: r._z for r in with_curve(df, ["a", "b"], bounds, 2).collect()}
    weave = lambda x, y: sum(((x >> i) & 1) << 2 * i | ((y >> i) & 1) << (2 * i + 1) for i in range(2))
    assert got == {a: weave(a // 4, (15 - a) // 4) for a in range(16)}
    assert rank_bounds(df.limit(0), ["a"], 2) == {"a": []}


def test_bucketed_join_moves_and_sorts_nothing(spark):
    ev = publish(c._hot(spark, SF001), "test-hot")
    joined = bucketed_join(spark, ev, rollup_sessions(ev, gap_seconds=c.LATE_GAP, key="start"))
    p = plan(joined)
    assert "SortMergeJoin" in p and "Exchange" not in p
    assert joined.count() == ev.count()


def test_compaction_leaves_what_is_in_order(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    df = spark.range(30_000).select("id", F.expr("date_add(DATE'2024-01-01', int(id % 3))").alias("day"))
    df.filter("day < '2024-01-03'").repartition(5).write.partitionBy("day").parquet(path)
    df.filter("day >= '2024-01-03'").coalesce(1).write.mode("append").partitionBy("day").parquet(path)
    sizes = {r.part: r.n for r in data_files(spark, path).groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sizes == {"day=2024-01-01": 5, "day=2024-01-02": 5, "day=2024-01-03": 1}
    kept = os.listdir(f"{path}/day=2024-01-03")
    assert compact_small(spark, path, "day") == ["2024-01-01", "2024-01-02"]
    assert compact_small(spark, path, "day") == []
    assert os.listdir(f"{path}/day=2024-01-03") == kept
    assert rows(spark.read.parquet(path).select("id", F.col("day").cast("date").alias("day"))) == rows(df)
    one = os.path.getsize(next(f"{path}/day=2024-01-01/{x}" for x in os.listdir(f"{path}/day=2024-01-01") if x.endswith(".parquet")))
    assert compact_small(spark, path, "day", target_bytes=one // 3) == []  # too few files is no fault


def test_landing_files_are_opened_once(spark, tmp_dir, monkeypatch):
    """After the raw lines are written the landing files may go: schema and rows come from the raw table."""
    land = f"{tmp_dir}/landing"
    os.makedirs(land)
    with open(f"{land}/a.json", "w") as fh:
        fh.write('{"event_id": 1, "title_id": 4, "ratio": 0.5, "more": {"x": [1, 2], "y": null}}\n{"event_id": 2, "title_id": "x", "more": {"z": true}}\n{broken\n')
    real = bronze.evolve_from_raw

    def landing_gone(*args):
        shutil.rmtree(land)
        os.makedirs(land)
        return real(*args)

    monkeypatch.setattr(bronze, "evolve_from_raw", landing_gone)
    out = bronze.ingest_heartbeats(spark, land, f"{tmp_dir}/b", f"{tmp_dir}/cp", schema_store=f"{tmp_dir}/schema")
    assert out["rows"] == 3
    schema, _ = files.load_schema(spark, f"{tmp_dir}/schema")
    assert schema["ratio"].dataType == T.DoubleType() and schema["title_id"].dataType == T.IntegerType()
    assert schema["more"].dataType.simpleString() == "struct<x:array<bigint>,y:string,z:boolean>"
    b = spark.read.schema(schema.add("_rescued_data", "string").add("_source_file", "string")).parquet(f"{tmp_dir}/b")
    got = {r.event_id: r for r in b.collect()}
    assert got[1].ratio == 0.5 and got[1].more.x == [1, 2] and got[1]._rescued_data is None
    assert got[2]._rescued_data is not None and got[2].more.z is True
    assert got[None]._rescued_data == "{broken" and got[1]._source_file.endswith("a.json")
    assert bronze.ingest_heartbeats(spark, land, f"{tmp_dir}/b", f"{tmp_dir}/cp", schema_store=f"{tmp_dir}/schema")["rows"] == 0


def test_many_batches_are_all_counted(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    os.makedirs(land)
    for i in range(120):
        with open(f"{land}/{i}.json", "w") as fh:
            fh.write('{"event_id": %d}\n' % i)
    out = bronze.ingest_heartbeats(spark, land, f"{tmp_dir}/b", f"{tmp_dir}/cp", max_files_per_trigger=1)
    assert out == {"batches": 120, "rows": 120}
