"""Landed pages, fetch rules, replace-day upsert and the streaming ingest."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import snap
from seatcast.plans import build
from seatcast.sources import pages, store
from seatcast.streaming.ingest import start_ingest_stream

AT = dt.datetime(2024, 1, 2, 8, 0, 0)


def ev(i, price=10.0):
    return {"id": f"e{i}", "name": f"Show {i}", "priceRanges": [{"min": price, "max": price}],
            "dates": {"start": {"dateTime": "2024-03-01T20:00:00Z"}, "status": {"code": "onsale"}},
            "_embedded": {"venues": [{"name": "V", "city": {"name": "Oslo"}}],
                          "attractions": [{"name": "A"}]}}


def land(root, day, city, number, events, total=None, fname=None):
    d = os.path.join(root, f"snapshot_date={day}", f"city={city}")
    os.makedirs(d, exist_ok=True)
    page = {"page": {"number": number, "totalPages": total}, "_embedded": {"events": events}}
    if not events:
        page = {"page": {"number": number, "totalPages": total}}
    with open(os.path.join(d, fname or f"page-{number}.json"), "w") as f:
        f.write(json.dumps(page) + "\n")


def ids(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


def report(spark, root):
    return {r.city: (r.pages, r.repeats, r.unreadable, r.missing, r.events)
            for r in pages.page_report(pages.read_pages(spark, root)).collect()}


# city -> (pages as (number, announced total, event ids), extra raw lines,
#          ids expected, (pages, repeats, unreadable, missing, events))
LANDED = {
    "many": ([(n, 7, [f"m{n}"]) for n in range(7)], [], [f"m{n}" for n in range(7)],
             (7, 0, 0, 0, 7)),
    "empty-between": ([(0, 3, ["b0"]), (1, 3, []), (2, 3, ["b2"])], [], ["b0", "b2"],
                      (3, 0, 0, 0, 2)),
    "more-than-announced": ([(0, 1, ["c0"]), (1, 2, ["c1"])], [], ["c0", "c1"], (2, 0, 0, 0, 2)),
    "no-total": ([(0, None, ["d0"]), (1, None, ["d1"])], [], ["d0", "d1"], (2, 0, 0, 0, 2)),
    "gap": ([(0, 4, ["g0"]), (3, 4, ["g3"])], [], ["g0", "g3"], (2, 0, 0, 2, 2)),
    "damaged": ([(0, 3, ["h0"]), (2, 3, ["h2"])], ['{"page": {"number": 1, "totalP'],
                ["h0", "h2"], (2, 0, 1, 1, 2)),
}


def test_every_landed_page_counts(spark):
    root = tempfile.mkdtemp(prefix="pages-")
    for city, (landed, lines, _, _) in LANDED.items():
        for number, total, events in landed:
            land(root, "2024-01-01", city, number, [ev(e) for e in events], total=total)
        for i, line in enumerate(lines):
            with open(os.path.join(root, "snapshot_date=2024-01-01", f"city={city}",
                                   f"raw-{i}.json"), "w") as f:
                f.write(line + "\n")
    # a page fetched twice under two names; the later file wins
    land(root, "2024-01-01", "again", 0, [ev("x0")], total=2)
    land(root, "2024-01-01", "again", 1, [ev("old")], total=2, fname="try-1.json")
    os.utime(os.path.join(root, "snapshot_date=2024-01-01", "city=again", "try-1.json"), (1, 1))
    land(root, "2024-01-01", "again", 1, [ev("x1")], total=2, fname="try-2.json")
    got = ids(pages.landed_rows(spark, root))
    want = ["ex0", "ex1"] + ["e" + e for _, _, own, _ in LANDED.values() for e in own]
    assert got == sorted(want)
    assert report(spark, root) == {c: v[3] for c, v in LANDED.items()} | {"again": (3, 1, 0, 0, 2)}
    r = pages.landed_rows(spark, root).filter("event_id = 'em0'").first()
    assert str(r.snapshot_date) == "2024-01-01" and r.venue_city == "Oslo"
    # a cap is the caller's wish only
    assert len(ids(pages.landed_rows(spark, root, max_pages=1))) == 7


def test_ingest_counters_and_strict(spark):
    root = tempfile.mkdtemp(prefix="count-")
    odd = ev("c") | {"dates": {"start": {"localDate": "someday"}}}
    land(root, "2024-01-01", "A", 0, [ev("a"), ev("b"), odd], total=2)
    path = os.path.join(tempfile.mkdtemp(prefix="store-"), "s")
    out = build.ingest_landed(spark, root, path, ingested_at=AT)
    assert out == {"pages": 1, "repeats": 0, "unreadable": 0, "missing": 1, "events": 3,
                   "rows": 3, "days": 1, "emptied_days": 0, "rejected_dates": 1}
    with pytest.raises(build.BadLandingError):
        build.ingest_landed(spark, root, path, strict=True)
    # the search window keeps dated events inside it
    out = build.ingest_landed(spark, root, path, as_of=dt.datetime(2024, 2, 1), days_ahead=60,
                              ingested_at=AT)
    assert out["rows"] == 2 and store.newest_day(spark, path) == dt.date(2024, 1, 1)


def test_one_file_a_day_and_only_touched_days_listed(spark, raw_df):
    path = os.path.join(tempfile.mkdtemp(prefix="store-"), "s")
    rows = raw_df([snap(f"e{i}", f"2024-01-0{1 + i % 3}", 1.0, 2.0) for i in range(90)])
    store.upsert_days(rows.repartition(16), path)
    for day in (1, 2, 3):
        files = [f for f in os.listdir(f"{path}/snapshot_date=2024-01-0{day}")
                 if f.endswith(".parquet")]
        assert len(files) == 1, files
    root = tempfile.mkdtemp(prefix="days-")
    for d in (1, 2):
        land(root, f"2024-01-0{d}", "A", 0, [ev(d)], total=1)
    one = pages.read_pages(spark, root, [dt.date(2024, 1, 2)])
    assert len(one.inputFiles()) == 1 and "2024-01-02" in one.inputFiles()[0]
    assert [str(r.snapshot_date) for r in one.select("snapshot_date").collect()] == ["2024-01-02"]


def test_replace_day_rerun_empty_and_duplicates(spark, raw_df):
    path = os.path.join(tempfile.mkdtemp(prefix="store-"), "s")
    day1 = [snap("x", "2024-01-01", 1.0, 2.0), snap("y", "2024-01-01", 3.0, 4.0)]
    day2 = [snap("x", "2024-01-02", 5.0, 6.0)]
    store.upsert_days(raw_df(day1 + day2), path)
    assert store.read_store(spark, path).count() == 3
    # rerun of day 1 with one row: day 1 replaced, day 2 untouched
    store.upsert_days(raw_df([snap("z", "2024-01-01", 7.0, 8.0)]), path)
    got = sorted((str(r.snapshot_date), r.event_id) for r in store.read_store(spark, path).collect())
    assert got == [("2024-01-01", "z"), ("2024-01-02", "x")]
    # empty batch for day 2: the day is emptied (DELETE ran before the inserts)
    out = store.upsert_days(raw_df([]), path, days=[dt.date(2024, 1, 2)])
    assert out["emptied_days"] == 1
    assert ids(store.read_store(spark, path)) == ["z"]
    # duplicate key: nothing written
    with pytest.raises(store.DuplicateKeyError):
        store.upsert_days(raw_df([snap("q", "2024-01-03", 1.0, 1.0),
                                  snap("q", "2024-01-03", 2.0, 2.0)]), path)
    assert ids(store.read_store(spark, path)) == ["z"]
    store.upsert_days(raw_df([snap("q", "2024-01-03", 1.0, 1.0),
                              snap("q", "2024-01-03", 2.0, 2.0)]), path, dedupe=True)
    assert ids(store.read_store(spark, path)) == ["q", "z"]
    # which of two equal keys stays does not depend on their order
    two = [snap("p", "2024-01-09", 3.0, 4.0), snap("p", "2024-01-09", 2.0, 9.0)]
    assert store.one_per_key(raw_df(two)).collect() == store.one_per_key(raw_df(two[::-1])).collect()
    # an event without an id cannot be stored
    from seatcast.schemas import SNAPSHOT
    no_id = spark.createDataFrame([snap("n", "2024-01-04", 1.0, 1.0)], SNAPSHOT.fieldNames()) \
        .withColumn("event_id", F.lit(None).cast("string"))
    with pytest.raises(store.DuplicateKeyError):
        store.upsert_days(no_id, path)
    assert ids(store.read_store(spark, path)) == ["q", "z"]


def test_stream_equals_batch_late_page_and_rerun(spark):
    base = tempfile.mkdtemp(prefix="stream-")
    root, path, ckpt = (os.path.join(base, x) for x in ("landing", "store", "ckpt"))
    land(root, "2024-01-01", "A", 0, [ev(1), ev(2)], total=2)
    land(root, "2024-01-02", "A", 0, [ev(3)], total=1)
    q = start_ingest_stream(spark, root, path, ckpt, ingested_at=AT)
    q.awaitTermination()
    assert ids(store.read_store(spark, path)) == ["e1", "e2", "e3"]
    # a late second page of day 1 arrives: the day is rebuilt from all its pages
    land(root, "2024-01-01", "A", 1, [ev(4)], total=2)
    q = start_ingest_stream(spark, root, path, ckpt, ingested_at=AT)
    q.awaitTermination()
    streamed = sorted((str(r.snapshot_date), r.event_id)
                      for r in store.read_store(spark, path).collect())
    assert streamed == [("2024-01-01", "e1"), ("2024-01-01", "e2"), ("2024-01-01", "e4"),
                        ("2024-01-02", "e3")]
    # rerun with nothing new adds nothing
    q = start_ingest_stream(spark, root, path, ckpt, ingested_at=AT)
    q.awaitTermination()
    assert store.read_store(spark, path).count() == 4
    # batch ingestion of the same landing folder gives the same rows
    batch = sorted((str(r.snapshot_date), r.event_id)
                   for r in pages.landed_rows(spark, root).collect())
    assert batch == streamed


def test_event_window_filters(spark, raw_df):
    raw = raw_df([snap("a", "2024-01-01", 1.0, 2.0, event_date="2024-01-10 20:00:00"),
                  snap("b", "2024-01-01", 1.0, 2.0, event_date="2024-05-10 20:00:00"),
                  snap("c", "2024-01-01", 1.0, 2.0, event_date="2023-12-31 20:00:00"),
                  snap("d", "2024-01-01", 1.0, 2.0, event_date="2024-01-11 20:00:00",
                       city="Bergen")])
    as_of = dt.datetime(2024, 1, 1, 0, 0, 0)
    assert ids(pages.event_window(raw, as_of)) == ["a", "d"]                  # 90-day window
    assert ids(pages.event_window(raw, as_of, city="Bergen")) == ["d"]
    assert ids(pages.event_window(raw, as_of, days_ahead=200, genre="Rock")) == ["a", "b", "d"]


def test_stream_dedupe_and_files_per_trigger(spark):
    base = tempfile.mkdtemp(prefix="stream-")
    root, path, ckpt = (os.path.join(base, x) for x in ("landing", "store", "ckpt"))
    for n in range(4):
        land(root, f"2024-01-0{1 + n % 2}", "A", n // 2, [ev(n), ev("same")], total=2)
    q = start_ingest_stream(spark, root, path, ckpt, ingested_at=AT, dedupe=True,
                            files_per_trigger=1)
    q.awaitTermination()
    assert len(q.recentProgress) >= 4
    assert ids(store.read_store(spark, path)) == ["e0", "e1", "e2", "e3", "esame", "esame"]
