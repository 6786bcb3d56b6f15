"""Whole jobs: mart build, rule file round trip, alert check, genre seed."""

import datetime as dt
import json
import os
import tempfile

from conftest import snap
from seatcast.plans import build
from seatcast.sources import rules as rules_io
from seatcast.sources import seeds


def _raw(raw_df):
    rows = [snap("z", f"2024-01-0{i + 1}", p, p, artist="Loud Band")
            for i, p in enumerate([10.0] * 6 + [30.0])]
    rows += [snap("w", f"2024-01-0{i + 1}", 5.0, 9.0, artist="Quiet Band") for i in range(7)]
    return raw_df(rows)


def test_build_marts(spark, raw_df):
    for staged in (False, True):
        out = build.build_marts(_raw(raw_df), tempfile.mkdtemp(prefix="marts-"),
                                stage_history=staged)
        assert set(out) == {"price_curves", "best_buy_windows", "soldout_velocity",
                            "price_anomalies"}
        an = spark.read.parquet(out["price_anomalies"])
        assert an.filter("anomaly_type = 'spike'").count() == 1
        assert spark.read.parquet(out["soldout_velocity"]).count() == 2


def test_rules_file_and_alert_check(spark, raw_df):
    base = tempfile.mkdtemp(prefix="rules-")
    path = os.path.join(base, "alerts.json")
    assert rules_io.read_rules(spark, path).count() == 0            # missing file: no rules
    with open(path, "w") as f:
        json.dump([{"target_price": 8.0, "created_at": "2024-01-01", "triggered": False,
                    "artist_name": "quiet"},
                   {"target_price": 1.0, "created_at": "2024-01-01", "triggered": False,
                    "event_id": "z"}], f, indent=2)
    rules = rules_io.read_rules(spark, path)
    assert [(r.rule_id, r.artist_name, r.event_id) for r in rules.orderBy("rule_id").collect()] \
        == [(0, "quiet", None), (1, None, "z")]
    as_of = dt.datetime(2024, 1, 8, 7, 0, 0)
    dry = build.run_alert_check(spark, _raw(raw_df), path, save_to=None, as_of=as_of)
    assert [r.rule_id for r in dry["hits"].collect()] == [0]
    assert [r.kind for r in dry["anomalies"].collect()] == ["spike"]
    assert dry["digest"].filter("position = 0").count() == 2
    saved = os.path.join(base, "v2")
    build.run_alert_check(spark, _raw(raw_df), path, save_to=saved, as_of=as_of)
    back = {r.rule_id: r for r in rules_io.read_rules(spark, saved).collect()}
    assert sorted(back) == [0, 1]
    assert back[0].triggered is True and back[0].triggered_price == 5.0
    assert back[1].triggered is False
    # the next day starts from the saved rules: all there, none hit again
    again = os.path.join(base, "v3")
    second = build.run_alert_check(spark, _raw(raw_df), saved, save_to=again, as_of=as_of)
    assert second["hits"].count() == 0 and second["rules"].count() == 2
    assert not os.path.exists(again)


def test_rule_files_round_trip_and_bad_files(spark):
    import pytest
    base = tempfile.mkdtemp(prefix="rules-")
    rules = rules_io.rules_frame(spark, [(float(i), f"c{i}", i % 2 == 0, str(i), None)
                                         for i in range(13)])
    rules_io.save_rules(rules.repartition(3), os.path.join(base, "v1"))
    back = rules_io.read_rules(spark, os.path.join(base, "v1"))
    assert sorted(back.collect()) == sorted(rules.collect())
    bad = os.path.join(base, "bad.json")
    for text in ('[{"target_price": 1.0,', '{"target_price": oops}'):
        with open(bad, "w") as f:
            f.write(text)
        with pytest.raises(Exception):
            rules_io.read_rules(spark, bad).collect()


def test_genre_seed(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="seed-"), "genres")
    seeds.write_genre_seed(spark, path)
    got = {r.source_genre: r.display_genre for r in
           seeds.read_genre_seed(spark, path).collect()}
    assert len(got) == 15 and got["Hip-Hop/Rap"] == "Hip-Hop"
