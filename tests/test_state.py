"""Kept state against full rebuilds: replaced, thinned out, emptied and appended days,
a crash in between, and what an update reads."""

import datetime as dt
import os
import random
import shutil

import pytest

from conftest import d, snap
from seatcast.functions import stable
from seatcast.operators import alerts, marts, reports, staging
from seatcast.plans import build, daily
from seatcast.schemas import SNAPSHOT
from seatcast.sources import store
from seatcast.state import files, history, prices, totals

DAYS = [f"2024-01-{i:02d}" for i in range(1, 13)]
STAMP = dt.datetime(2024, 1, 31)


def _rows(seed, days):
    rnd = random.Random(seed)
    out = []
    for day in days:
        for e in range(9):
            if rnd.random() < 0.25:
                continue
            low = rnd.choice([None, 10.0, 10.5, 20.0, 33.33, 0.07])
            high = None if low is None or rnd.random() < 0.1 else low + rnd.choice([0, 1.01, 40.0])
            out.append(snap(f"e{e}", day, low, high, genre=f"g{e % 2}" if e % 4 else None,
                            city=f"c{e % 3}", name="Renamed" if e == 1 and day > DAYS[5] else None,
                            event_date=None if e == 8 else f"2024-0{1 + e % 3}-20 20:00:00",
                            status=rnd.choice(["onsale", "onsale", "offsale"])))
    return out


def _put(spark, path, state, rows, days=None, parts=None):
    done = store.upsert_days(spark.createDataFrame(rows, SNAPSHOT), path, ingested_at=STAMP,
                             days=[d(x) for x in days] if days else None)
    if parts is None:
        daily.refresh(spark, path, state, done["replaced"])
    else:
        daily.refresh(spark, path, state, done["replaced"], parts)
    return done["replaced"]


def _same(got, want, floats=()):
    def rows(df):
        df = df.select(sorted(df.columns)).withColumns({c: stable(c, 9) for c in floats})
        return sorted(map(tuple, df.collect()), key=str)
    assert rows(got) == rows(want)


def _check_all(spark, path, state):
    raw = store.read_store(spark, path)
    snaps = staging.price_snapshots(staging.stg_events(raw))
    moments = daily.kept(spark, state, prices.MOMENTS)
    counts = daily.kept(spark, state, prices.PRICE_COUNTS)
    _same(prices.event_stats(moments), marts.event_stats(snaps), ["stddev_price"])
    _same(prices.alert_stats(moments), alerts.price_stats(raw), ["stddev_price"])
    _same(prices.price_curves(counts), marts.price_curves(snaps))
    _same(prices.curve_report(counts), reports.curve_report(raw))
    _same(prices.curve_report(counts, "g1", "c1"), reports.curve_report(raw, "g1", "c1"))
    _same(prices.best_buy_windows(daily.kept(spark, state, prices.WEEKDAYS), min_observations=2),
          marts.best_buy_windows(snaps, min_observations=2))
    _same(history.read(spark, f"{state}/history"), snaps)


@pytest.fixture
def kept(spark, tmp_path):
    """A store of all days but the last two, and its state."""
    path, state = str(tmp_path / "store"), str(tmp_path / "state")
    _put(spark, path, state, _rows(1, DAYS[:10]))
    return path, state


def test_replaced_emptied_and_appended_days(spark, kept):
    path, state = kept
    _check_all(spark, path, state)
    # a middle day with other prices and fewer events, and one with none left
    _put(spark, path, state, _rows(2, [DAYS[4]])[:3], days=[DAYS[4], DAYS[6]])
    _check_all(spark, path, state)
    assert not os.path.exists(f"{state}/history/rows/snapshot_date={DAYS[6]}")
    # the newest day appended, then the first and the newest day replaced
    _put(spark, path, state, _rows(3, [DAYS[10]]))
    _put(spark, path, state, _rows(4, [DAYS[0], DAYS[10]]))
    _check_all(spark, path, state)
    out = daily.build_marts(spark, state, f"{state}-marts")
    full = build.build_marts(store.read_store(spark, path), f"{state}-full")
    for name in full:
        _same(spark.read.parquet(out[name]), spark.read.parquet(full[name]),
              ["stddev_price"] if name == "price_anomalies" else [])


def test_update_of_a_new_day_reads_that_day_and_the_state(spark, kept, tmp_path):
    """All other days' folders are taken away while the newest is added."""
    path, state = kept
    rows = _rows(5, [DAYS[10]])
    away = tmp_path / "away"
    away.mkdir()
    store.upsert_days(spark.createDataFrame(rows, SNAPSHOT), path, ingested_at=STAMP)
    old = [n for n in os.listdir(path) if n.startswith("snapshot_date=") and DAYS[10] not in n]
    assert len(old) == 10
    for n in old:
        shutil.move(f"{path}/{n}", away / n)
    parts = [t.name for t in prices.TOTALS]
    daily.refresh(spark, path, state, [d(DAYS[10])], parts)
    rules = str(tmp_path / "no-rules.json")
    found = daily.check_alerts(spark, path, state, rules, save_to=None, as_of=STAMP,
                               threshold=0.5)["anomalies"].collect()
    fresh = history.new_rows(spark, path, f"{state}/history", d(DAYS[10]),
                             history.start(spark, f"{state}/history", d(DAYS[10]))).collect()
    for n in old:
        shutil.move(away / n, f"{path}/{n}")
    raw = store.read_store(spark, path)
    today = alerts.latest_snapshot(raw, d(DAYS[10]))
    want = alerts.latest_anomalies(raw, today, 0.5).collect()
    assert [(r.event_id, r.z_rounded) for r in found] == [(r.event_id, r.z_rounded) for r in want]
    assert found
    snaps = staging.price_snapshots(staging.stg_events(raw)).where(f"snapshot_date = '{DAYS[10]}'")
    assert sorted(map(tuple, fresh), key=str) == sorted(map(tuple, snaps.collect()), key=str)


def test_replaced_day_rewinds_to_the_last_table_before_it(spark, kept):
    path, state = kept
    folder = f"{state}/history"
    base = history.start(spark, folder, d(DAYS[9]))
    every = [x for x in DAYS[:9] if d(x).toordinal() % history.EVERY == 0]
    assert base == (d(every[-1]) if every else None)
    history.update(spark, path, folder, [d(DAYS[0])], every=3)
    stays = [d(x) for x in DAYS[:10] if d(x).toordinal() % 3 == 0]
    assert history._days(spark, f"{folder}/last", "as_of") == sorted({*stays, d(DAYS[9])})
    day = next(x for x in DAYS[5:] if d(x).toordinal() % 3 == 2)
    assert history.start(spark, folder, d(day)) == d(day) - dt.timedelta(days=2)
    rows = history.new_rows(spark, path, folder, d(day), history.start(spark, folder, d(day)))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert f"(snapshot_date#" in plan and "PartitionFilters: [isnotnull(snapshot_date" in plan
    _put(spark, path, state, _rows(6, [day]), parts=[])
    history.update(spark, path, folder, [d(day)], every=3)
    snaps = staging.price_snapshots(staging.stg_events(store.read_store(spark, path)))
    _same(history.read(spark, folder), snaps)


def test_crash_before_the_commit_changes_nothing(spark, kept, monkeypatch):
    path, state = kept
    folder = f"{state}/{prices.PRICE_COUNTS.name}"
    before = sorted(map(tuple, totals.read(spark, folder).collect()), key=str)
    replaced = _put(spark, path, state, _rows(7, [DAYS[3]]), parts=[])
    rows = store.read_store(spark, path)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(files, "commit_text", fail)
        with pytest.raises(OSError):
            totals.update(spark, prices.PRICE_COUNTS, folder, rows, replaced)
    assert sorted(map(tuple, totals.read(spark, folder).collect()), key=str) == before
    for _ in range(4):  # the rerun, and reruns of it, whose old files go
        totals.update(spark, prices.PRICE_COUNTS, folder, rows, replaced)
    snaps = staging.price_snapshots(staging.stg_events(rows))
    _same(prices.price_curves(totals.read(spark, folder)), marts.price_curves(snaps))
    assert len(files.names(spark, f"{folder}/total")) == totals.KEEP
    assert len(files.names(spark, f"{folder}/commits")) == totals.KEEP


def test_crash_in_the_history_is_seen_and_mended(spark, kept, monkeypatch):
    path, state = kept
    folder = f"{state}/history"
    assert history.is_current(spark, path, folder)
    replaced = _put(spark, path, state, _rows(8, [DAYS[2], DAYS[11]]), parts=[])

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(history, "_keep_last", fail)
        with pytest.raises(OSError):
            history.update(spark, path, folder, replaced)
    assert not history.is_current(spark, path, folder)
    history.update(spark, path, folder, replaced)
    assert history.is_current(spark, path, folder)
    snaps = staging.price_snapshots(staging.stg_events(store.read_store(spark, path)))
    _same(history.read(spark, folder), snaps)


def test_all_rows_gone_and_no_state(spark, tmp_path):
    path, state = str(tmp_path / "s"), str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        daily.kept(spark, state, prices.MOMENTS)
    daily.refresh(spark, path, state, [])
    _put(spark, path, state, _rows(9, DAYS[:1]), parts=[t.name for t in prices.TOTALS])
    shutil.rmtree(f"{path}/snapshot_date={DAYS[0]}")
    daily.refresh(spark, path, state, [d(DAYS[0])], [t.name for t in prices.TOTALS])
    for total in prices.TOTALS:
        assert daily.kept(spark, state, total).count() == 0


def test_equal_prices_have_no_deviation(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(3, 30, 300000, 3 * 10100000 ** 2), (1, 1, 0, 10 ** 12),
                                (2, 3, 0, 5 * 10 ** 12)], "n long, w long, f long, q long")
    got = df.select(prices.stddev_of_sums(F.col("n"), F.col("w"), F.col("f"), F.col("q")))
    assert [r[0] for r in got.collect()] == [0.0, None, pytest.approx(0.5 ** 0.5)]
