"""Nested API events -> flat rows: each case against its one expected row."""

import json

import pytest
from pyspark.sql import functions as F

from seatcast.schemas import API_EVENT
from seatcast.sources.pages import flatten_events, landed_rows, page_report, read_pages

COLUMNS = ["event_id", "name", "event_date", "venue_name", "venue_city", "venue_state",
           "venue_capacity", "genre", "subgenre", "artist_name", "min_price", "max_price",
           "currency", "status", "url", "date_rejected"]
BLANK = dict.fromkeys(COLUMNS, "") | {
    "event_id": None, "event_date": None, "venue_capacity": None, "min_price": None,
    "max_price": None, "currency": "USD", "date_rejected": False}


def start(**when):
    return {"dates": {"start": when}}


# (event, what differs from a blank row)
CASES = [
    ({}, {}),
    ({"id": "only-first-of-each-list", "priceRanges": [{"min": 7, "max": 9.5, "currency": "NOK"},
                                                       {"min": 1, "max": 2}],
      "classifications": [{"subGenre": {"name": "Bebop"}}, {"genre": {"name": "Jazz"}}],
      "_embedded": {"venues": [{"upcomingEvents": {"_total": 3}, "state": {"stateCode": "VA"}},
                               {"name": "not this"}],
                    "attractions": [{"name": "Quartet"}, {"name": "Support"}]}},
     {"event_id": "only-first-of-each-list", "min_price": 7.0, "max_price": 9.5,
      "currency": "NOK", "subgenre": "Bebop", "venue_capacity": 3, "venue_state": "VA",
      "artist_name": "Quartet"}),
    ({"priceRanges": [], "classifications": [], "_embedded": {"venues": [], "attractions": []}},
     {}),
    ({"priceRanges": [{"max": 40.0}]}, {"max_price": 40.0}),
    ({"url": "u", "name": "n", "dates": {"status": {"code": "offsale"}}},
     {"url": "u", "name": "n", "status": "offsale"}),
    (start(dateTime="2031-12-24T18:00:00Z", localDate="2031-12-25"),
     {"event_date": "2031-12-24 18:00:00"}),
    (start(dateTime="2031-12-24T18:00:00+02:00"), {"event_date": "2031-12-24 18:00:00"}),
    (start(dateTime="2025-03-09T12:30Z"), {"event_date": "2025-03-09 12:30:00"}),
    (start(dateTime="2025-03-09T02:30:00Z"), {"event_date": "2025-03-09 02:30:00"}),
    (start(dateTime="2031-12-24T18:00:00.250Z"), {"event_date": "2031-12-24 18:00:00.250000"}),
    (start(dateTime="", localDate="2031-02-03"), {"event_date": "2031-02-03 00:00:00"}),
    (start(localDate="soon"), {"date_rejected": True}),
    (start(dateTime="2031-13-40T18:00:00Z"), {"date_rejected": True}),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_each_event_gives_its_row(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)   # 02:30 does not exist in one of them
    try:
        df = spark.createDataFrame([(i, json.dumps(e)) for i, (e, _) in enumerate(CASES)],
                                   "i int, j string")
        flat = flatten_events(df.select("i", F.from_json("j", API_EVENT).alias("event")))
        rows = flat.withColumn("event_date", F.col("event_date").cast("string")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    got = {r.i: {c: r[c] for c in COLUMNS} for r in rows}
    for i, (_, differs) in enumerate(CASES):
        want = BLANK | differs
        have = got[i]
        if want["event_date"] and "." in want["event_date"]:
            want["event_date"] = want["event_date"].rstrip("0")
        assert have == want, CASES[i]


# defaulted field -> how an event holds a value for it
DEFAULTED = {
    "name": lambda v: {"name": v},
    "url": lambda v: {"url": v},
    "status": lambda v: {"dates": {"status": {"code": v}}},
    "venue_name": lambda v: {"_embedded": {"venues": [{"name": v}]}},
    "venue_city": lambda v: {"_embedded": {"venues": [{"city": {"name": v}}]}},
    "venue_state": lambda v: {"_embedded": {"venues": [{"state": {"stateCode": v}}]}},
    "artist_name": lambda v: {"_embedded": {"attractions": [{"name": v}]}},
    "genre": lambda v: {"classifications": [{"genre": {"name": v}}]},
    "subgenre": lambda v: {"classifications": [{"subGenre": {"name": v}}]},
    "currency": lambda v: {"priceRanges": [{"currency": v}]},
}


def without_key(tree, gone):
    """``tree`` without the keys that hold ``gone``."""
    if isinstance(tree, dict):
        return {k: without_key(v, gone) for k, v in tree.items() if v != gone}
    return [without_key(v, gone) for v in tree] if isinstance(tree, list) else tree


def rows_of(spark, texts, parse):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, j string")
    flat = flatten_events(df.select("i", parse("j").alias("event")))
    return {r.i: r for r in flat.withColumn("event_date", F.col("event_date").cast("string"))
            .collect()}


def test_variants_tell_null_from_missing(spark):
    cases = [(field, made, want)
             for field, holds in DEFAULTED.items()
             for made, want in ((holds("here"), "here"), (holds(None), None),
                                (without_key(holds("gone"), "gone"), BLANK[field]))]
    # a null object or list on the way counts as missing
    cases += [("venue_city", {"_embedded": {"venues": [{"city": None}]}}, ""),
              ("artist_name", {"_embedded": {"attractions": None}}, ""),
              ("currency", {"priceRanges": None}, "USD")]
    got = rows_of(spark, [json.dumps(e) for _, e, _ in cases], F.try_parse_json)
    assert len(cases) == 33
    for i, (field, event, want) in enumerate(cases):
        assert got[i][field] == want, (field, event)
        assert all(got[i][c] == BLANK[c] for c in COLUMNS if c != field), (field, event)
    # structs give the default for both
    plain = rows_of(spark, [json.dumps(e) for _, e, _ in cases],
                    lambda j: F.from_json(j, API_EVENT))
    for i, (field, _, want) in enumerate(cases):
        assert plain[i][field] == (BLANK[field] if want is None else want)


def test_variants_give_the_same_rows_without_nulls(spark):
    texts = [json.dumps(e) for e, _ in CASES] + ["no json"]
    got = rows_of(spark, texts, F.try_parse_json)
    want = rows_of(spark, texts, lambda j: F.from_json(j, API_EVENT))
    assert {i: tuple(r) for i, r in got.items() if i < len(CASES)} == \
        {i: tuple(r) for i, r in want.items() if i < len(CASES)}
    assert got[len(CASES)].event_id is None


def test_landed_pages_keep_nulls(spark, tmp_path):
    day = tmp_path / "snapshot_date=2031-05-01" / "city=Oslo"
    day.mkdir(parents=True)
    events = [{"id": "a", "name": None}, {"id": "b"}, {"id": "c", "name": "C"}]
    page = {"page": {"number": 0, "totalPages": 1}, "_embedded": {"events": events}}
    later = page | {"_embedded": {"events": events[:2] + [{"id": "c", "name": "later"}]}}
    (day / "1.json").write_text("\n".join(map(json.dumps, (page, later))) + "\n{broken\n")
    rows = landed_rows(spark, str(tmp_path), keep_nulls=True).collect()
    names = {r.event_id: r.name for r in rows}
    assert len(rows) == 3 and names.pop("c") in ("C", "later") and names == {"a": None, "b": ""}
    assert {r.event_id: r.name for r in landed_rows(spark, str(tmp_path)).collect()}["a"] == ""
    report = page_report(read_pages(spark, str(tmp_path), keep_nulls=True)).first()
    assert (report.pages, report.repeats, report.unreadable, report.events) == (2, 1, 1, 3)
