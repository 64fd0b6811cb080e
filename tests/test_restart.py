"""Runs that die: the ledger, notes, and loaders that are run again."""

import datetime as dt

import pytest

from test_streaming_jobs import _deliver
from watchtide.config import PipelineConfig
from watchtide.plans import jobs
from watchtide.schemas import BRONZE_TITLE, GOLD_FCT_SESSIONS
from watchtide.sources import notes
from watchtide.sources.notes import Ledger, load_note, save_note
from watchtide.sources.tables import append_table, read_table

LOADERS = ["events", "dim", "fct_events", "sessions"]  # the query run_day_restarted has them all


class Died(Exception):
    pass


def test_ledger_keeps_what_is_not_struck(spark, tmp_dir):
    ledger = Ledger(spark, f"{tmp_dir}/ledger")
    assert ledger.owed("a").entries == [] and ledger.owe("a") == []
    first = ledger.owe("a", ["2024-01-03", "2024-01-01"])
    ledger.owe("a", [dt.date(2024, 1, 2)], since="2024-02-01")
    ledger.owe("b", since="2024-03-01")
    owed = ledger.owed("a")
    assert owed.dates == ["2024-01-01", "2024-01-02", "2024-01-03"] and owed.since == "2024-02-01" and len(owed.entries) == 2
    late = ledger.owe("a", ["2024-05-05"])  # entered while the loader was at work
    ledger.strike("a", owed.entries)
    assert ledger.owed("a").entries == late and ledger.owed("b").since == "2024-03-01"
    ledger.strike("a", first)  # striking twice does nothing
    assert ledger.owed("a").dates == ["2024-05-05"]


def test_a_note_is_there_whatever_write_dies(spark, tmp_dir, monkeypatch):
    store = f"{tmp_dir}/note"
    assert load_note(spark, store) is None
    for n in range(3):
        save_note(spark, {"n": n}, store)
        assert load_note(spark, store) == {"n": n}

    def dies(*_):
        raise Died

    with monkeypatch.context() as m:
        m.setattr(notes, "_put", dies)
        with pytest.raises(Died):
            save_note(spark, {"n": 8}, store)
    assert load_note(spark, store) == {"n": 2}
    with monkeypatch.context() as m:
        m.setattr(notes, "_drop", dies)
        with pytest.raises(Died):
            save_note(spark, {"n": 9}, store)
    assert load_note(spark, store) == {"n": 9}
    save_note(spark, {"n": 10}, store)
    assert load_note(spark, store) == {"n": 10}


def _title(spark, snap, name):
    row = (1, name, ["a"], "t", 2000, 10, None, None, "f", snap, dt.datetime(2024, 1, 1))
    return spark.createDataFrame([row], BRONZE_TITLE)


def _first_days(spark, root):
    """A month loaded; then late events of its second week and a new snapshot come."""
    cfg = PipelineConfig(root=root)
    append_table(_title(spark, "2024-01-01", "x"), cfg.path("bronze", "dim_title"), "_snapshot_date")
    _deliver(spark, cfg, [(d, d % 2, d * 86400 + 60) for d in range(28)], "2024-01-29")
    jobs.run_day(spark, cfg)
    append_table(_title(spark, "2024-01-10", "y"), cfg.path("bronze", "dim_title"), "_snapshot_date")
    _deliver(spark, cfg, [(100 + i, i % 2, 8 * 86400 + 600 * i) for i in range(20)], "2024-01-31")
    return cfg


def _tables(spark, cfg):
    out = {}
    for layer, name in (("silver", "playback_events"), ("silver", "viewing_sessions"), ("gold", "fct_playback_events"),
                        ("gold", "fct_viewing_sessions"), ("gold", "mart_engagement"), ("gold", "mart_qos")):
        df = read_table(spark, cfg.path(layer, name))
        out[name] = sorted(map(str, df.select(*sorted(df.columns)).collect()))
    return out


def _run(spark, cfg, **options):
    return jobs.run_day(spark, cfg, processing_date="2024-01-31", ingest_date="2024-01-31", **options)


@pytest.fixture(scope="module")
def undisturbed(spark, tmp_path_factory):
    cfg = _first_days(spark, str(tmp_path_factory.mktemp("lake")))
    _run(spark, cfg)
    return _tables(spark, cfg)


def test_a_run_that_dies_after_its_loaders(spark, tmp_dir, undisturbed):
    cfg = _first_days(spark, tmp_dir)
    for loader in LOADERS:
        def after(done, loader=loader):
            if done == loader:
                raise Died
        with pytest.raises(Died):
            _run(spark, cfg, after=after)
    _run(spark, cfg)
    assert _tables(spark, cfg) == undisturbed
    assert all(not Ledger(spark, f"{cfg.ops}/ledger").owed(x).entries for x in ("sessions", "fct_events", "fct_sessions"))


@pytest.mark.parametrize("step, before", [("append_table", False), ("overwrite_dates", True), ("save_note", False)])
def test_a_run_that_dies_within_a_loader(spark, tmp_dir, undisturbed, monkeypatch, step, before):
    """Dead just before or after a commit, at the first of its kind; the next run is of another date."""
    cfg = _first_days(spark, tmp_dir)
    real = getattr(jobs, step)

    def dies(*args, **kw):
        if not before:
            real(*args, **kw)
        raise Died

    with monkeypatch.context() as m:
        m.setattr(jobs, step, dies)
        with pytest.raises(Died):
            _run(spark, cfg)
    if step in ("append_table", "write_table"):
        jobs.load_events(spark, cfg, ingest_date="2024-01-31")
    jobs.run_day(spark, cfg, processing_date="2024-02-02", ingest_date="2024-02-02")
    assert _tables(spark, cfg) == undisturbed


def test_late_dates_stay_owed_until_the_loaders_have_done_them(spark, tmp_dir):
    cfg = _first_days(spark, tmp_dir)
    report = jobs.load_events(spark, cfg, ingest_date="2024-01-31")
    ledger = Ledger(spark, f"{cfg.ops}/ledger")
    assert report.dates == ["2024-01-09"] and ledger.owed("sessions").dates == report.dates == ledger.owed("fct_events").dates
    assert jobs.load_events(spark, cfg, ingest_date="2024-01-31").rows == 0
    jobs.load_fct_events(spark, cfg, "2024-02-20")
    assert ledger.owed("sessions").dates == report.dates and ledger.owed("fct_events").dates == []
    jobs.load_sessions(spark, cfg, "2024-02-20")
    assert ledger.owed("sessions").dates == [] and "2024-01-09" in ledger.owed("fct_sessions").dates
    jobs.load_dim(spark, cfg)
    jobs.load_fct_sessions(spark, cfg, "2024-02-20")
    assert ledger.owed("fct_sessions").entries == []
    fct = read_table(spark, cfg.path("gold", "fct_viewing_sessions"), GOLD_FCT_SESSIONS)
    assert fct.filter("session_date = '2024-01-09'").agg({"heartbeats": "sum"}).first()[0] == 21


def test_a_filter_without_its_events_does_no_harm(spark, tmp_dir, monkeypatch):
    """The run dies when the filters are written and the events are not; then more events of that date come."""
    cfg = PipelineConfig(root=tmp_dir)
    _deliver(spark, cfg, [(i, 1, i) for i in range(50)], "2024-01-02")

    def dies(*_, **__):
        raise Died

    with monkeypatch.context() as m:
        m.setattr(jobs, "append_table", dies)
        with pytest.raises(Died):
            jobs.load_events(spark, cfg)
    _deliver(spark, cfg, [(i, 1, i % 80_000) for i in range(40, 6000)], "2024-01-03")
    assert jobs.load_events(spark, cfg).rows == 6000
    _deliver(spark, cfg, [(i, 1, i % 80_000) for i in range(5990, 6010)], "2024-01-04")
    assert jobs.load_events(spark, cfg, ingest_date="2024-01-04").rows == 10
    silver = read_table(spark, cfg.path("silver", "playback_events"))
    assert silver.count() == 6010 == silver.select("event_id").distinct().count()
