"""Late snapshots, keys seen before, and versions in merged order."""

import datetime as dt
from itertools import product

import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_streaming_jobs import _deliver
from watchtide.config import PipelineConfig
from watchtide.operators.joins import asof_dim_join, asof_merged
from watchtide.operators.membership import blocks_of, filter_rows, insert_unseen, maybe_seen
from watchtide.operators.merge import insert_new
from watchtide.operators.scd2 import DIM_COLS, scd2_rebuild
from watchtide.plans import jobs
from watchtide.schemas import BRONZE_TITLE, SEEN_KEYS, SILVER_EVENTS
from watchtide.sources.notes import Ledger
from watchtide.sources.tables import append_table, partition_values, read_table, table_exists

SNAPS = ["2024-01-01", "2024-01-08", "2024-01-16", "2024-01-20"]


def _bronze(spark, snap):
    """Every course that a title can take over four snapshots: absent, a, or b in each."""
    at = SNAPS.index(snap)
    data = [(i, x[at], None, "t", 2000, 10, None, None, "f", snap, dt.datetime(2024, 1, 1))
            for i, x in enumerate(product(["", "a", "b"], repeat=4)) if x[at]]
    return spark.createDataFrame(data, BRONZE_TITLE)


@pytest.mark.parametrize("order", [(3, 2, 1, 0), (2, 0, 3, 1)])
def test_snapshots_in_any_order_give_the_history_of_their_dates(spark, tmp_dir, order):
    cfg = PipelineConfig(root=tmp_dir)
    for i in order:
        append_table(_bronze(spark, SNAPS[i]), cfg.path("bronze", "dim_title"), "_snapshot_date")
        jobs.load_titles(spark, cfg)
        assert jobs.load_dim(spark, cfg) == [SNAPS[i]]
        assert Ledger(spark, f"{cfg.ops}/ledger").owed("fct_sessions").since <= SNAPS[i]
    from watchtide.operators.clean import clean_titles
    every = _bronze(spark, SNAPS[0])
    for s in SNAPS[1:]:
        every = every.unionByName(_bronze(spark, s))
    cols = [c for c in DIM_COLS if c != "genres"]
    assert rows(jobs.read_dim(spark, cfg), *cols) == rows(scd2_rebuild(clean_titles(every)), *cols)
    assert jobs.load_dim(spark, cfg) == []


def test_late_ones_among_new_ones(spark, tmp_dir):
    cfg = PipelineConfig(root=tmp_dir)
    append_table(_bronze(spark, SNAPS[2]), cfg.path("bronze", "dim_title"), "_snapshot_date")
    jobs.load_titles(spark, cfg)
    jobs.load_dim(spark, cfg)
    for i in (3, 0, 1):
        append_table(_bronze(spark, SNAPS[i]), cfg.path("bronze", "dim_title"), "_snapshot_date")
    jobs.load_titles(spark, cfg)
    assert jobs.load_dim(spark, cfg) == [SNAPS[0], SNAPS[1], SNAPS[3]]
    from watchtide.operators.clean import clean_titles
    every = _bronze(spark, SNAPS[0])
    for s in SNAPS[1:]:
        every = every.unionByName(_bronze(spark, s))
    cols = [c for c in DIM_COLS if c != "genres"]
    assert rows(jobs.read_dim(spark, cfg), *cols) == rows(scd2_rebuild(clean_titles(every)), *cols)


def test_closed_versions_are_written_once(spark, tmp_dir):
    cfg = PipelineConfig(root=tmp_dir)
    for s in SNAPS:
        append_table(_bronze(spark, s), cfg.path("bronze", "dim_title"), "_snapshot_date")
        jobs.load_titles(spark, cfg)
        jobs.load_dim(spark, cfg)
    root = cfg.path("gold", "dim_title")
    assert partition_values(spark, root, "closed") == SNAPS[1:] and partition_values(spark, root, "asof") == SNAPS[1:]
    closed = jobs.read_dim(spark, cfg).filter("NOT is_current")
    part = F.regexp_extract(F.input_file_name(), "closed=([0-9-]+)", 1)
    assert closed.select(part.alias("p"), F.col("valid_to").cast("string").alias("v")).filter("p <> v").count() == 0


def _keys(spark, ids, day="2024-01-01"):
    return spark.createDataFrame([(i, dt.date.fromisoformat(day)) for i in ids], "event_id long, event_date date")


def test_no_key_is_missed_and_few_are_mistaken(spark):
    old, new = _keys(spark, range(20_000)), _keys(spark, range(1_000_000, 1_020_000))
    f = filter_rows(old, ["event_id"], "event_date", blocks_of(old, "event_date"))
    assert f.agg(F.max(F.octet_length("bits"))).first()[0] == 4096 and f.count() == 8
    assert maybe_seen(old, f, ["event_id"], "event_date").filter("NOT maybe_seen").count() == 0
    assert maybe_seen(new, f, ["event_id"], "event_date").filter("maybe_seen").count() < 0.06 * 20_000


def test_added_parts_unknown_dates_and_null_keys(spark):
    a, b = _keys(spark, range(100)), _keys(spark, range(100, 200))
    blocks = blocks_of(a, "event_date")
    f = filter_rows(a, ["event_id"], "event_date", blocks).unionByName(filter_rows(b, ["event_id"], "event_date", blocks))
    batch = a.unionByName(b).unionByName(_keys(spark, [5], "2024-01-02")).unionByName(_keys(spark, [None]))
    got = maybe_seen(batch, f, ["event_id"], "event_date")
    assert got.filter("maybe_seen").count() == 201  # a date without a filter is unknown
    assert got.filter("event_id IS NULL AND NOT maybe_seen").count() == 1
    target = a.unionByName(b)
    source = _keys(spark, [1, 150, 900]).unionByName(_keys(spark, [None, None])).unionByName(_keys(spark, [1], "2024-01-02"))
    assert rows(insert_unseen(target, source, ["event_id"], "event_date", f)) == rows(insert_new(target, source, ["event_id", "event_date"]))
    assert insert_unseen(target, source.limit(0), ["event_id"], "event_date", f).count() == 0
    assert rows(insert_unseen(target, source, ["event_id"], "event_date", f.limit(0))) == rows(insert_new(target, source, ["event_id", "event_date"]))


def test_keys_are_not_sent_to_every_task(spark, tmp_dir):
    """Blocks are (a row per date), however small the keys seem; so all tasks that read keys set their bits."""
    _keys(spark, range(2000)).write.parquet(f"{tmp_dir}/k")
    keys = spark.read.parquet(f"{tmp_dir}/k")
    p = filter_rows(keys, ["event_id"], "event_date", blocks_of(keys, "event_date"))._jdf.queryExecution().sparkPlan().toString()
    assert "BuildRight" in p and "BuildLeft" not in p


def test_what_was_seen_is_not_added_to_the_filters_again(spark, tmp_dir):
    cfg = PipelineConfig(root=tmp_dir)
    stored = lambda: sorted((r.event_date, r.block, bytes(r.bits)) for r in read_table(spark, f"{cfg.ops}/seen_events", SEEN_KEYS).collect())
    _deliver(spark, cfg, [(i, i % 5, i % 3 * 86400 + i) for i in range(90)], "2024-01-05")
    assert jobs.load_events(spark, cfg).rows == 90
    first = stored()
    assert jobs.load_events(spark, cfg).rows == 0 and stored() == first
    _deliver(spark, cfg, [(i, i % 5, i % 4 * 86400 + i) for i in range(80, 100)], "2024-01-06")
    assert jobs.load_events(spark, cfg).rows > 0  # of a stored date and of a new one
    events = read_table(spark, cfg.path("silver", "playback_events"), SILVER_EVENTS)
    assert maybe_seen(events, read_table(spark, f"{cfg.ops}/seen_events", SEEN_KEYS), ["event_id"], "event_date").filter("NOT maybe_seen").isEmpty()
    assert not table_exists(spark, f"{cfg.ops}/staging/playback_events_told")


def test_only_dates_of_possible_repeats_are_read(spark, tmp_dir):
    days = [f"2024-01-{d:02d}" for d in range(1, 11)]
    for i, d in enumerate(days):
        _keys(spark, range(i * 100, i * 100 + 100), d).write.mode("append").partitionBy("event_date").parquet(f"{tmp_dir}/t")
    target = spark.read.parquet(f"{tmp_dir}/t").withColumn("event_date", F.col("event_date").cast("date"))
    f = filter_rows(target, ["event_id"], "event_date", blocks_of(target, "event_date"))
    f.write.parquet(f"{tmp_dir}/f")
    out = insert_unseen(target, _keys(spark, [305], days[3]).unionByName(_keys(spark, [99_999], days[0])), ["event_id"], "event_date", spark.read.parquet(f"{tmp_dir}/f"))
    assert rows(out, "event_id") == [(99_999,)]
    p = out._jdf.queryExecution().executedPlan().toString()
    assert days[3] in p and days[7] not in p


def _versions(spark, n):
    base = dt.date(2021, 1, 1)
    v = [(1, base + dt.timedelta(days=i), base + dt.timedelta(days=i + 1), i) for i in range(n)]
    v += [(2, base, base + dt.timedelta(days=40), 1), (2, base + dt.timedelta(days=60), dt.date(9999, 12, 31), 2), (None, base, dt.date(9999, 12, 31), 9)]
    return spark.createDataFrame(v, "title_id long, valid_from date, valid_to date, title_sk long")


@pytest.mark.parametrize("block_days, salts", [(1, 1), (7, 3), (1000, 1)])
def test_merged_order_equals_the_range_join(spark, block_days, salts):
    base = dt.date(2020, 12, 20)
    facts = [(i, i % 4 or None, base + dt.timedelta(days=i * 7 % 1100) if i % 50 else None, "x") for i in range(2000)]
    facts = spark.createDataFrame(facts, "event_id long, title_id long, session_date date, _block string")
    dim = _versions(spark, 1000)
    options = {"block_days": block_days, "salts": salts, "salt_cols": ["event_id"]}
    want = asof_dim_join(facts, dim, dim_cols=["title_sk", "valid_from"])
    got = asof_merged(facts, dim, dim_cols=["title_sk", "valid_from"], **options)
    assert got.columns == want.columns and rows(got) == rows(want)
    assert rows(asof_merged(facts, dim, how="inner", **options)) == rows(asof_dim_join(facts, dim, how="inner"))
    assert asof_merged(facts.limit(0), dim).count() == 0 and asof_merged(facts, dim.limit(0)).filter("title_sk IS NULL").count() == 2000
    with pytest.raises(ValueError):
        asof_merged(facts, dim, how="full")


def test_merged_order_joins_no_fact_with_a_version(spark):
    facts = spark.createDataFrame([(1, 1, dt.date(2021, 2, 1))], "event_id long, title_id long, session_date date")
    p = asof_merged(facts, _versions(spark, 10))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in p


def test_dimension_writes_take_small_shuffled_partitions_and_give_the_setting_back(spark, tmp_dir, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter
    from watchtide.session import ADVISORY
    cfg, seen, write = PipelineConfig(root=tmp_dir), {}, DataFrameWriter.parquet

    def noted(self, path, *args, **kw):
        seen[path.removeprefix(tmp_dir).rsplit("/", 1)[-1]] = spark.conf.get(ADVISORY)
        return write(self, path, *args, **kw)

    append_table(_bronze(spark, SNAPS[0]), cfg.path("bronze", "dim_title"), "_snapshot_date")
    before = spark.conf.get(ADVISORY)
    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    try:
        for size, wanted in (("1g", 16 << 20), ("2m", 2 << 20)):
            spark.conf.set(ADVISORY, size)
            seen.clear()
            jobs.load_titles(spark, cfg, force=[SNAPS[0]])
            jobs._publish_dim(spark, cfg, jobs.empty_dim(spark), "2024-01-01")
            assert {seen[x] for x in (f"_snapshot_date={SNAPS[0]}", "_next")} == {str(wanted)}
            assert spark.conf.get(ADVISORY) == size
    finally:
        spark.conf.set(ADVISORY, before)
