"""Alert rules, the gram-indexed contains lookup, marking and digests."""

import datetime as dt
import random
import re

from conftest import snap
from seatcast.operators import alerts
from seatcast.operators.textmatch import cheapest_per_pattern
from seatcast.sources.rules import rules_frame

AS_OF = dt.datetime(2024, 2, 1, 9, 30, 0)


def today_of(raw):
    return alerts.latest_snapshot(raw, alerts.newest_day(raw))


def newest_day_raw(raw_df):
    return today_of(raw_df([
        snap("old", "2024-01-01", 1.0, 2.0, artist="Blue Widgets"),     # not the newest day
        snap("1", "2024-01-02", 40.0, 60.0, artist="Blue Widgets"),
        snap("2", "2024-01-02", 30.0, None, artist="Red Widgets"),
        snap("3", "2024-01-02", 25.0, 35.0, artist="100% Pure"),
        snap("4", "2024-01-02", None, None, artist="Quiet Widgets"),
        snap("5", "2024-01-02", 12.5, 20.0, artist="U2"),
        snap("6", "2024-01-02", 99.0, 120.0, artist="back\\slash"),
    ]))


RULES = [
    (45.0, "2024-01-01 10:00:00", False, "1", None),          # 0 by id: 40 <= 45
    (35.0, "2024-01-01 10:00:00", False, None, "widgets"),    # 1 cheapest widget: Red 30
    (10.0, "2024-01-01 10:00:00", False, "5", "widgets"),     # 2 id wins: 12.5 > 10, no hit
    (10.0, "2024-01-01 10:00:00", False, None, None),         # 3 neither
    (10.0, "2024-01-01 10:00:00", False, "", ""),             # 4 blanks = neither
    (99.0, "2024-01-01 10:00:00", True, None, "widgets"),     # 5 already triggered
    (26.0, "2024-01-01 10:00:00", False, None, "0% p"),       # 6 '%' inside: matches '100% Pure'
    (25.0, "2024-01-01 10:00:00", False, None, "pure"),       # 7 target equal to price
    (13.0, "2024-01-01 10:00:00", False, None, "%"),          # 8 wildcard only: cheapest 12.5
    (13.0, "2024-01-01 10:00:00", False, None, "___"),        # 9 >= 3 chars: U2 too short
    (100.0, "2024-01-01 10:00:00", False, None, "k\\s"),      # 10 literal backslash
    (100.0, "2024-01-01 10:00:00", False, "missing", None),   # 11 unknown id
    (35.0, "2024-01-01 10:00:00", False, "", "red"),          # 12 blank id, artist used
]


def test_price_alerts_rule_cases(spark, raw_df):
    hits = alerts.price_alerts(newest_day_raw(raw_df), rules_frame(spark, RULES))
    got = {r.rule_id: (r.event_id, r.current_price) for r in hits.collect()}
    assert got == {0: ("1", 40.0), 1: ("2", 30.0), 6: ("3", 25.0), 7: ("3", 25.0),
                   8: ("5", 12.5), 10: ("6", 99.0), 12: ("2", 30.0)}
    row = {r.rule_id: r for r in hits.collect()}[1]
    assert row.avg_price is None and row.event_date == "2024-03-01 20:00:00"


def _like_contains(text, pattern):
    rx = "".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch)
                 for ch in pattern.lower())
    return re.search(rx, text.lower(), re.S) is not None


def test_contains_lookup_matches_brute_force(spark):
    rnd = random.Random(7)
    alphabet = "abcde %_"
    texts = ["".join(rnd.choice("abcde ") for _ in range(rnd.randint(0, 9))) for _ in range(60)]
    rows = [(i, t, float(rnd.randint(1, 50))) for i, t in enumerate(texts)]
    pats = [(j, "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 4))))
            for j in range(80)]
    got = {r.pid: (r.price, r.id) for r in cheapest_per_pattern(
        spark.createDataFrame(rows, "id long, t string, price double"), "t",
        spark.createDataFrame(pats, "pid long, p string"), "p", "pid", ["price", "id"]).collect()}
    want = {}
    for pid, p in pats:
        cands = [(price, i) for i, t, price in rows if _like_contains(t, p)]
        if cands:
            want[pid] = min(cands)
    assert got == want


def test_mark_default_and_compat(spark, raw_df):
    rules = rules_frame(spark, [
        (35.0, "c0", False, None, "widgets"),   # 0 hits (Red 30)
        (5.0, "c1", False, None, "pure"),       # 1 no hit, but no event id either
        (5.0, "c2", False, "9", None),          # 2 no hit, has an id, no artist
        (45.0, "c3", False, "1", None),         # 3 hits by id
        (5.0, "c4", True, "7", "zzz"),          # 4 triggered before, untouched by default
    ])
    hits = alerts.price_alerts(newest_day_raw(raw_df), rules)
    d = {r.rule_id: r for r in alerts.mark_triggered(rules, hits, AS_OF).collect()}
    assert [d[i].triggered for i in range(5)] == [True, False, False, True, True]
    assert d[0].triggered_price == 30.0 and d[0].triggered_at == "2024-02-01 09:30:00"
    assert d[4].triggered_at is None
    c = {r.rule_id: r for r in alerts.mark_triggered(rules, hits, AS_OF, compat=True).collect()}
    # hit 0 (no event id) marks every rule without an event id -> rule 1;
    # hit 3 (no artist) marks every rule without an artist -> rule 2 and rule 3
    assert [c[i].triggered for i in range(5)] == [True, True, True, True, True]
    assert c[1].triggered_price == 30.0
    assert c[2].triggered_price == 40.0 and c[3].triggered_price == 40.0
    assert c[4].triggered_at is None                     # no key equal to a hit's


def test_compat_last_hit_sets_price(spark, raw_df):
    rules = rules_frame(spark, [
        (35.0, "a", False, None, "red"),        # hit 30
        (45.0, "b", False, None, "blue"),       # hit 40 (later in rule order)
    ])
    hits = alerts.price_alerts(newest_day_raw(raw_df), rules)
    c = {r.rule_id: r for r in alerts.mark_triggered(rules, hits, AS_OF, compat=True).collect()}
    assert c[0].triggered_price == 40.0 and c[1].triggered_price == 40.0


def test_rule_status_listing(spark):
    rules = rules_frame(spark, [
        {"target_price": 49.5, "created_at": "2024-05-06 07:08:09", "triggered": False,
         "artist_name": "Someone"},
        {"target_price": 50.5, "triggered": True, "event_id": "E1", "artist_name": ""},
        {"target_price": 10.0},
    ])
    rows = alerts.rule_status(rules).orderBy("rule_id").collect()
    assert [(r.target, r.identifier, r.status, r.created, r.active_rules) for r in rows] == [
        ("$50", "Someone", "active", "2024-05-06", 2),
        ("$50", "E1", "TRIGGERED", "?", 2),      # half to even, empty artist counts as absent
        ("$10", "?", "active", "?", 2),
    ]


def test_digest_lines(spark, raw_df):
    rules = rules_frame(spark, [(45.0, "c", False, "1", None)])
    hits = alerts.price_alerts(newest_day_raw(raw_df), rules)
    rows = alerts.price_alert_digest(hits).orderBy("position").collect()
    assert rows[0].line == "Price Alert: 1 ticket(s) hit your target!"
    assert rows[1].line == ("  Blue Widgets — Show 1\n  Current price: $40 (target: $45)\n"
                            "  Seattle | 2024-03-01 20:00:00\n")


def test_latest_anomalies_newest_day_only(spark, raw_df):
    prices = [10.0] * 6 + [30.0]
    rows = [snap("z", f"2024-01-0{i + 1}", p, p) for i, p in enumerate(prices)]
    rows += [snap("y", f"2024-01-0{i + 1}", p, p) for i, p in enumerate([30.0] + [10.0] * 6)]
    raw = raw_df(rows)
    out = alerts.latest_anomalies(raw, today_of(raw)).collect()
    assert [(r.event_id, r.kind) for r in out] == [("z", "spike")]
    assert round(out[0].z_score, 6) == round((30 - 90 / 7) / 7.559289460184544, 6)


def test_thousands_of_equal_and_one_letter_rules(spark, raw_df):
    # equal patterns are answered once and fanned out; short ones stay exact
    rules = rules_frame(spark, [(50.0, "c", False, None, p)
                                for p in ["widgets"] * 1500 + ["e", "U", "%", "z"] * 300])
    hits = alerts.price_alerts(newest_day_raw(raw_df), rules)
    by_event = {r.event_id: r.n for r in hits.groupBy("event_id").count()
                .withColumnRenamed("count", "n").collect()}
    # "e" is cheapest at 25 (100% Pure), "U" and "%" at 12.5 (U2), "z" has none
    assert by_event == {"2": 1500, "3": 300, "5": 600}


def test_digest_counts_all_anomalies(spark, raw_df):
    rows = []
    for i in range(30):
        rows += [snap(f"e{i:02d}", f"2024-01-0{d + 1}", p, p)
                 for d, p in enumerate([10.0] * 6 + [30.0 + i])]
    raw = raw_df(rows)
    far = alerts.latest_anomalies(raw, today_of(raw), limit=None)
    digest = alerts.anomaly_digest(far, 10).collect()
    assert [r.line for r in digest if r.position == 0] == \
        ["Price Anomalies: 0 drops, 30 spikes detected"]
    assert sum(r.section == "spike" for r in digest) == 10
    assert alerts.latest_anomalies(raw, today_of(raw), limit=20).count() == 20
