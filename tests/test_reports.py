"""Report queries on hand-made rows."""

import datetime as dt

from conftest import snap
from seatcast.operators import reports


def test_half_priced_rows_counted_not_averaged(spark, raw_df):
    raw = raw_df([snap("a", "2024-01-01", 10.0, 20.0), snap("b", "2024-01-01", 40.0, None),
                  snap("c", "2024-01-01", None, None)])
    (r,) = reports.curve_report(raw).collect()
    assert r.num_observations == 2 and r.mean_price == 15.0 and r.median_price == 15.0
    (k,) = reports.kpi_summary(raw).collect()
    assert (k.total_events, k.avg_price, k.lowest_price) == (2, 15.0, 10.0)


def test_kpi_all_unpriced_gives_nulls(spark, raw_df):
    (k,) = reports.kpi_summary(raw_df([snap("c", "2024-01-01", None, None)])).collect()
    assert k.total_events == 0 and k.avg_price is None and k.last_updated is None


def test_explorer_newest_snapshot_and_search(spark, raw_df):
    raw = raw_df([
        snap("a", "2024-01-01", 10.0, 20.0, status="onsale", artist="The Band"),
        snap("a", "2024-01-02", 11.0, 21.0, status="offsale", artist="The Band"),
        snap("b", "2024-01-02", 5.0, 6.0, artist="Solo", event_date="2023-12-01 20:00:00"),
        snap("c", "2024-01-02", 7.0, 8.0, artist="50%_off"),
    ])
    as_of = dt.datetime(2024, 1, 10)
    got = {r.artist_name: r for r in reports.event_explorer(raw, as_of).collect()}
    assert set(got) == {"The Band", "50%_off"}        # past event dropped
    assert got["The Band"].status == "offsale" and got["The Band"].min_price == 11.0
    assert [r.artist_name for r in reports.event_explorer(raw, as_of, search="BAND").collect()] \
        == ["The Band"]
    # the search text's % and _ are wildcards (no escape character)
    assert len(reports.event_explorer(raw, as_of, search="%_").collect()) == 2
    (s,) = reports.explorer_summary(reports.event_explorer(raw, as_of)).collect()
    assert (s.upcoming_events, s.on_sale) == (2, 1)


def test_sellout_and_weekday_summaries(spark, raw_df):
    rows = []
    for i in range(4):
        rows.append(snap(f"s{i}", "2024-01-01", 1.0, 2.0))
        rows.append(snap(f"s{i}", f"2024-01-0{2 + i}", 1.0, 2.0, status="offsale"))
    raw = raw_df(rows)
    rep = reports.sellout_report(raw)
    assert [r.days_to_sellout for r in rep.collect()] == [1, 2, 3, 4]
    (s,) = reports.sellout_summary(rep).collect()
    assert (s.median_days, s.fastest_days) == (2.5, 1)
    hist = [(r.bin_start, r.bin_end, r.num_events) for r in reports.sellout_histogram(rep).collect()]
    assert hist == [(1, 1, 1), (2, 2, 1), (3, 3, 1), (4, 4, 1)]
    assert reports.weekday_summary(reports.weekday_report(raw, min_observations=99)).count() == 0


def test_anomaly_report_filters_after_stats(spark, raw_df):
    rows = [snap("z", f"2024-01-0{i + 1}", p, p, genre="Jazz" if i == 6 else "Rock")
            for i, p in enumerate([10.0] * 6 + [30.0])]
    raw = raw_df(rows)
    assert reports.anomaly_report(raw, genre="Jazz").count() == 1   # stats still cover all days
    (s,) = reports.anomaly_summary(reports.anomaly_report(raw)).collect()
    assert (s.total_anomalies, s.price_drops, s.price_spikes) == (1, 0, 1)
    assert s.best_deal_artist is None


def test_display_headers(spark, raw_df):
    rows = [snap("z", f"2024-01-0{i + 1}", p, p) for i, p in enumerate([10.0] * 6 + [30.0])]
    rep = reports.anomaly_report(raw_df(rows))
    shown = reports.with_display_headers(rep, "anomalies")
    assert shown.columns == ["Artist", "Event", "City", "Current $", "Avg $", "Z-Score", "Type",
                             "Date"]
    table = reports.with_display_headers(reports.sellout_table(raw_df(rows)), "sellout")
    assert table.columns == ["Artist", "Event", "City", "Days to Sell Out"]


def test_summaries_cover_more_than_the_lists_show(spark, raw_df):
    rows = []
    for i in range(70):                              # the list shows 50
        rows.append(snap(f"s{i:02d}", "2024-01-01", 1.0, 2.0))
        rows.append(snap(f"s{i:02d}", f"2024-01-{2 + i % 20:02d}", 1.0, 2.0, status="offsale"))
    raw = raw_df(rows)
    every = reports.sellout_report(raw, limit=None)
    assert reports.sellout_report(raw).count() == 50 and every.count() == 70
    (s,) = reports.sellout_summary(every).collect()
    assert (s.median_days, s.fastest_days) == (9.0, 1)
    bins = reports.sellout_histogram(every).collect()
    assert sum(b.num_events for b in bins) == 70 and len(bins) <= 15
