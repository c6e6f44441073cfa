"""The life of snapshots, and windows that compute every day once."""

from datetime import date, timedelta

import pytest

from tablewright.operators.assemble import assemble
from tablewright.plans import daily
from tablewright.plans import panel as P
from tablewright.plans.daily import DayStore, assemble_window, gaps
from tablewright.plans.jobs import train
from tablewright.plans.pipeline import linear_regression, make_model
from tablewright.plans.snapshot import SnapshotCache, fetch_data
from tablewright.session import path_exists, shared_dir

from .conftest import SF001

ENTITIES = """
    select distinct user_id as id, cast(ts as date) as `date` from events
    where ts >= :start_date and ts < date_add(:end_date, 1)
"""


@pytest.fixture
def events(spark):
    P.register_events(spark, SF001)
    return spark


def _raw_folder(df):
    return df.inputFiles()[0].rsplit("/", 1)[0]


def test_recorded_leased_and_fresh_data_survive(events, tmp_path):
    cache = SnapshotCache(events, str(tmp_path / "snap"))
    window = P.window(events)
    queries = P.panel_queries()
    result = train(
        events, queries=queries, raw_model=P.EventPanelRaw, processed_model=P.EventPanelProcessed, cache=cache,
        pipeline=make_model("prod", selected=["spend", "clicks"], regressor=linear_regression(), handle_unknown="ignore"),
        training_cutoff=window["end_date"], num_samples=5,
    )
    from tablewright.plans.records import RunStore

    logged = RunStore(events).runs().where(f"run_id = '{result.run_id}'").first().params["raw_data"]
    frame = fetch_data(events, window, queries, data_model=P.EventPanelRaw, cache=cache)
    n = frame.count()
    assert cache.clear() == [] and cache.purge() == []
    assert path_exists(events, logged) and frame.count() == n  # fetched: leased
    fresh = fetch_data(events, window, queries, data_model=P.EventPanelRaw, cache=cache)
    assert _raw_folder(fresh) != _raw_folder(frame)  # cleared: not returned again

    # when leases and grace have run out, what no run recorded goes
    cache.grace = timedelta(0)
    import shutil

    for lease in (tmp_path / "snap" / "leases").iterdir():
        shutil.rmtree(lease)
    cache.lease("elsewhere/run", timedelta(seconds=-1))
    gone = cache.purge()
    assert list((tmp_path / "snap" / "leases").iterdir()) == []
    assert [p.rstrip("/") for p in gone] == [_raw_folder(frame).removeprefix("file://")]
    assert path_exists(events, logged) and fresh.count() == n


def test_expired_snapshots_wait_for_their_grace(events, tmp_path):
    cache = SnapshotCache(events, str(tmp_path / "snap"), ttl=timedelta(0))
    frame = fetch_data(events, P.window(events), P.panel_queries(), data_model=P.EventPanelRaw, cache=cache)
    assert cache.purge() == [] and frame.count() > 0
    assert cache.purge(recorded=[_raw_folder(frame)]) == []
    assert len(cache.purge(recorded=[])) == 1


def test_gaps():
    d = lambda n: date(2024, 1, n)
    days = [d(n) for n in range(1, 8)]
    assert gaps(days, set()) == [(d(1), d(7))]
    assert gaps(days, {d(1), d(4), d(5)}) == [(d(2), d(3)), (d(6), d(7))]
    assert gaps(days, set(days)) == []


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_overlapping_windows_compute_each_day_once(events, tmp_path, monkeypatch):
    queries = {k: v for k, v in P.panel_queries().items() if k != "index"} | {"entities": ENTITIES}
    store = DayStore(events, str(tmp_path / "days"))
    filled = []
    real = DayStore._fill
    monkeypatch.setattr(DayStore, "_fill", lambda self, key, q, params, *a: filled.append((key, params["start_date"], params["end_date"])) or real(self, key, q, params, *a))
    first, last = P.window(events).values()
    mid = first + timedelta(days=9)
    for lo, hi in ((mid, mid + timedelta(days=5)), (first, mid + timedelta(days=1)), (first, last), (mid, last)):
        got = assemble_window(events, queries, lo, hi, entities="entities", store=store).joined
        want = assemble(events, P.panel_queries(), {"start_date": lo, "end_date": hi}).joined
        assert _rows(got.select(*want.columns)) == _rows(want)
    for key in {k for k, *_ in filled}:
        days = [d for k, lo, hi in filled if k == key for d in daily.days_between(lo, hi)]
        assert sorted(days) == daily.days_between(first, last)  # every day, none twice


def test_changed_days_are_gaps_again(events, tmp_path):
    store = DayStore(events, str(tmp_path / "days"))
    first, last = P.window(events).values()
    version = dict.fromkeys(daily.days_between(first, last), "v1")
    fetch = lambda q=ENTITIES, **p: store.fetch(q, first, last, p, version_of=version.get)
    want, key = _rows(fetch()), store.key(ENTITIES, {})
    version[first + timedelta(days=3)] = "v2"
    assert _rows(fetch()) == want
    runs = store.covered(key)
    assert len(runs) == len(version) + 1 and len(set(runs.values())) == 2
    assert store.key(ENTITIES + " and user_id > :u", {"u": 1}) != store.key(ENTITIES + " and user_id > :u", {"u": 2})
    assert store.key(ENTITIES, {"unused": 1}) == key


def test_a_query_that_leaves_its_window_is_refused(events, tmp_path):
    store = DayStore(events, str(tmp_path / "days"))
    first, last = P.window(events).values()
    with pytest.raises(ValueError, match="outside"):
        store.fetch("select distinct user_id as id, cast(ts as date) as `date` from events where :start_date <= :end_date", first, first, {})
    assert store.covered(store.key("x", {})) == {}
    empty = store.fetch(ENTITIES, last + timedelta(days=100), last + timedelta(days=101))
    assert empty.count() == 0 and empty.columns == ["id", "date"]
    assert shared_dir(events)


def test_stored_days_are_never_broadcast(events, tmp_path):
    """Files that compress well look small; the frames of a window are merged whatever their files' size."""
    queries = {k: v for k, v in P.panel_queries().items() if k != "index"} | {"entities": ENTITIES}
    first, last = P.window(events).values()
    got = assemble_window(events, queries, first, last, entities="entities", store=DayStore(events, str(tmp_path / "days"))).joined
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
