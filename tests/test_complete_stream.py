"""Staging and releasing landed pages: each file read once, each day stored once; late,
repeated and missing pages."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from test_ingest import AT, ev, land

from seatcast.plans import daily
from seatcast.sources import pages, store
from seatcast.state import prices
from seatcast.streaming import complete

T0 = dt.datetime(2024, 2, 1, 6, 0, 0)


def stage(spark, root, work, hours=0, **how):
    q = complete.stage_pages(spark, root, work, staged_at=T0 + dt.timedelta(hours=hours), **how)
    q.awaitTermination()
    return [p.numInputRows for p in q.recentProgress if p.numInputRows]


@pytest.fixture
def puts(monkeypatch):
    """Days of every call of the store's replacement."""
    seen, put = [], store.upsert_days

    def counted(rows, path, **how):
        seen.append([str(d) for d in how["days"]])
        return put(rows, path, **how)

    monkeypatch.setattr(store, "upsert_days", counted)
    return seen


def release(spark, work, path, **how):
    complete.release_days(spark, work, path, ingested_at=AT, **how).awaitTermination()


def stored(spark, path):
    return sorted((str(r.snapshot_date)[-2:], r.event_id, r.min_price)
                  for r in store.read_store(spark, path).collect())


def test_fifty_batches_read_each_file_once(spark, tmp_path, puts):
    root, work, path, state = (str(tmp_path / x) for x in ("landing", "work", "store", "state"))
    n = 0
    for number in range(5):  # days and cities interleaved: every batch touches another day
        for city in ("A", "B"):
            for day in range(1, 6):
                n += 1
                land(root, f"2024-01-0{day}", city, number, [ev(f"{day}{city}{number}", n)],
                     total=5)
                os.utime(f"{root}/snapshot_date=2024-01-0{day}/city={city}/page-{number}.json",
                         (1_700_000_000 + n, 1_700_000_000 + n))
    want = sorted((str(r.snapshot_date)[-2:], r.event_id, r.min_price)
                  for r in pages.landed_rows(spark, root).collect())
    batches = stage(spark, root, work, files_per_trigger=1)
    assert batches == [1] * 50
    shutil.rmtree(root)  # nothing reads the landing any more
    release(spark, work, path, files_per_trigger=7,
            on_release=lambda days: daily.refresh(spark, path, state, days, ["moments"]))
    assert stored(spark, path) == want and len(want) == 50
    assert sorted(d for call in puts for d in call) == [f"2024-01-0{d}" for d in range(1, 6)]
    assert daily.kept(spark, state, prices.MOMENTS).agg(F.sum("n")).first()[0] == 50


def test_late_repeated_and_missing_pages(spark, tmp_path, puts):
    root, work, path = (str(tmp_path / x) for x in ("landing", "work", "store"))
    land(root, "2024-01-01", "A", 0, [ev(1)], total=2)
    land(root, "2024-01-02", "A", 0, [ev(2)], total=1)
    land(root, "2024-01-02", "A", 9, [], fname="damaged.json")
    with open(f"{root}/snapshot_date=2024-01-02/city=A/damaged.json", "w") as f:
        f.write('{"page": {"number": 1, "to\n')
    stage(spark, root, work)
    release(spark, work, path)
    assert stored(spark, path) == [("02", "e2", 10.0)]  # day 1 waits for its second page
    # the second page; a repeated page with other prices; a second city of a stored day
    land(root, "2024-01-01", "A", 1, [ev(3)], total=2)
    land(root, "2024-01-02", "A", 0, [ev(2, 5.0)], total=1, fname="again.json")
    stage(spark, root, work, hours=1)
    release(spark, work, path)
    assert stored(spark, path) == [("01", "e1", 10.0), ("01", "e3", 10.0), ("02", "e2", 5.0)]
    # an incomplete day, and an incomplete second city of a stored one
    land(root, "2024-01-03", "A", 1, [ev(4)], total=3)
    land(root, "2024-01-01", "B", 0, [ev(5)], total=2)
    stage(spark, root, work, hours=2)
    release(spark, work, path)
    assert len(stored(spark, path)) == 3
    # patience is over once pages are staged twelve hours later; what is there is stored
    land(root, "2024-01-04", "A", 0, [ev(6)], total=1)
    stage(spark, root, work, hours=15)
    release(spark, work, path)
    assert stored(spark, path) == [
        ("01", "e1", 10.0), ("01", "e3", 10.0), ("01", "e5", 10.0), ("02", "e2", 5.0),
        ("03", "e4", 10.0), ("04", "e6", 10.0)]
    # a page that comes after that completes the day
    land(root, "2024-01-01", "B", 1, [ev(7)], total=2)
    stage(spark, root, work, hours=16)
    release(spark, work, path)
    batch = sorted((str(r.snapshot_date)[-2:], r.event_id, r.min_price)
                   for r in pages.landed_rows(spark, root).collect())
    assert [x[:2] for x in stored(spark, path)] == [x[:2] for x in batch]
    n = len(puts)
    stage(spark, root, work, hours=17)
    release(spark, work, path)  # nothing new: nothing is replaced
    assert len(puts) == n


def test_state_of_complete_days_is_forgotten(spark, tmp_path):
    """A page after that makes its day wait once, and loses nothing."""
    root, work, path = (str(tmp_path / x) for x in ("landing", "work", "store"))
    for hours, day, number in ((0, 1, 0), (24 * 40, 2, 0), (24 * 80, 3, 0), (24 * 81, 1, 1),
                               (24 * 82, 4, 0)):
        land(root, f"2024-01-0{day}", "A", number, [ev(10 * day + number)], total=1)
        stage(spark, root, work, hours=hours)
        release(spark, work, path)
    assert [x[1] for x in stored(spark, path)] == ["e10", "e11", "e20", "e30", "e40"]
