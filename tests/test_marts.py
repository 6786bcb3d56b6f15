"""Hand-made edge fixtures for staging and the marts."""

from decimal import Decimal

from conftest import snap
from seatcast.functions import bucket_order, days_bucket
from seatcast.operators import marts, staging


def hist(raw):
    return staging.price_snapshots(staging.stg_events(raw))


def test_bucket_edges(spark):
    days = [-2, 0, 1, 2, 3, 4, 7, 8, 14, 15, 30, 31, 60, 61, None]
    df = spark.createDataFrame([(x,) for x in days], "d long")
    got = [(r.d, r.label, r.o) for r in
           df.select("d", days_bucket("d").alias("label"), bucket_order("d").alias("o")).collect()]
    want = {-2: 7, 0: 7, 1: 7, 2: 6, 3: 6, 4: 5, 7: 5, 8: 4, 14: 4, 15: 3, 30: 3, 31: 2, 60: 2,
            61: 1, None: 7}
    assert {d: o for d, _, o in got} == want
    labels = {d: lab for d, lab, _ in got}
    assert labels[61] == "60+ days" and labels[1] == "day of" and labels[None] == "day of"


def test_lag_takes_previous_row_and_zero_guard(spark, raw_df):
    raw = raw_df([
        snap("e", "2024-01-01", 10.0, 20.0),   # avg 15
        snap("e", "2024-01-03", None, None),   # gap day, NULL price
        snap("e", "2024-01-04", 0.0, 0.0),     # avg 0
        snap("e", "2024-01-05", 5.0, 7.0),     # prev 0 -> pct NULL
        snap("e", "2024-01-06", 9.0, 9.0),
    ])
    rows = hist(raw).orderBy("snapshot_date").collect()
    assert [r.snapshot_number for r in rows] == [1, 2, 3, 4, 5]
    assert rows[0].prev_avg_price is None and rows[0].price_change is None
    assert rows[1].prev_avg_price == 15.0 and rows[1].price_change is None
    assert rows[2].prev_avg_price is None            # previous row had a NULL price
    assert rows[3].prev_avg_price == 0.0 and rows[3].price_change_pct is None
    assert rows[4].price_change_pct == Decimal("50.00")


def test_event_date_null_dropped_and_days_until(spark, raw_df):
    raw = raw_df([snap("a", "2024-01-01", 1.0, 2.0, event_date=None),
                  snap("b", "2024-01-05", 1.0, 2.0, event_date="2024-01-03 23:00:00")])
    rows = staging.stg_events(raw).collect()
    assert [r.event_id for r in rows] == ["b"]
    assert rows[0].days_until_event == -2


def _series(event_id, prices, name=None, start_day=1, **kw):
    return [snap(event_id, f"2024-01-{start_day + i:02d}", p, p, name=name, **kw)
            for i, p in enumerate(prices)]


def test_zscore_threshold_needs_six_rows(spark, raw_df):
    raw = raw_df(_series("flat", [50.0, 50.0, 50.0]) +
                 _series("five", [10.0] * 4 + [20.0]) +
                 _series("six", [10.0] * 5 + [20.0]))
    an = marts.price_anomalies(hist(raw))
    by = {(r.event_id, str(r.snapshot_date)): r for r in an.collect()}
    assert all(r.z_score == 0 and r.anomaly_type == "normal" for k, r in by.items()
               if k[0] == "flat")
    assert by[("five", "2024-01-05")].z_score == Decimal("1.79")
    assert by[("five", "2024-01-05")].anomaly_type == "normal"
    assert by[("six", "2024-01-06")].z_score == Decimal("2.04")
    assert by[("six", "2024-01-06")].anomaly_type == "spike"
    assert by[("six", "2024-01-06")].is_anomaly is True


def test_renamed_event_fans_out(spark, raw_df):
    raw = raw_df(_series("r", [10.0, 11.0, 12.0], name="Old Name") +
                 _series("r", [13.0, 14.0, 15.0], name="New Name", start_day=4))
    stats = marts.event_stats(hist(raw)).collect()
    assert len(stats) == 2
    assert marts.price_anomalies(hist(raw)).count() == 12   # 6 snapshots x 2 stats rows


def test_soldout_twice_and_rescheduled(spark, raw_df):
    raw = raw_df([
        snap("s", "2024-01-01", 1.0, 2.0),
        snap("s", "2024-01-03", 1.0, 2.0, status="offsale"),
        snap("s", "2024-01-05", 1.0, 2.0, status="offsale"),
        snap("m", "2024-01-01", 1.0, 2.0, event_date="2024-02-01 20:00:00"),
        snap("m", "2024-01-02", 1.0, 2.0, event_date="2024-02-08 20:00:00"),
    ])
    v = {(r.event_id, str(r.event_date)): r for r in marts.soldout_velocity(hist(raw)).collect()}
    s = v[("s", "2024-03-01 20:00:00")]
    assert str(s.soldout_date) == "2024-01-03" and s.days_to_sellout == 2 and s.did_sell_out
    # offsale on Jan 3 (58 days left) and Jan 5 (56 left): the smaller one is kept
    assert s.days_before_event_soldout == 56
    assert len([k for k in v if k[0] == "m"]) == 2
    assert all(not r.did_sell_out and r.days_to_sellout is None for k, r in v.items()
               if k[0] == "m")


def test_weekday_threshold_and_rank_gaps(spark, raw_df):
    # 2024-01-01 is a Monday; Mondays 01, 08, 15, 22, 29; Tuesdays 02, 09, 16, 23.
    rows = []
    for i, day in enumerate(["01", "08", "15", "22", "29"]):
        rows.append(snap(f"m{i}", f"2024-01-{day}", 10.0, 10.0))
    for i, day in enumerate(["02", "09", "16", "23"]):
        rows.append(snap(f"t{i}", f"2024-01-{day}", 5.0, 5.0))
    for i, day in enumerate(["03", "10", "17", "24", "31"]):   # Wednesdays, tie with Monday
        rows.append(snap(f"w{i}", f"2024-01-{day}", 10.0, 10.0))
    for i, day in enumerate(["04", "11", "18", "25", "04"]):   # Thursdays, cheapest
        rows.append(snap(f"h{i}", f"2024-01-{day}", 1.0, 1.0))
    out = marts.best_buy_windows(hist(raw_df(rows)))
    got = {r.day_name: (r.day_of_week, r.price_rank, r.num_observations) for r in out.collect()}
    assert "Tuesday" not in got                       # only 4 observations
    assert got["Thursday"] == (4, 1, 5)
    assert got["Monday"][1] == 2 and got["Wednesday"][1] == 2


def test_null_genre_city_group_sorted_last(spark, raw_df):
    raw = raw_df([snap("a", "2024-01-01", 1.0, 3.0, genre=None, city=None),
                  snap("b", "2024-01-01", 1.0, 3.0, genre=None, city=None),
                  snap("c", "2024-01-01", 1.0, 3.0, genre="Jazz", city="Oslo")])
    rows = marts.price_curves(hist(raw)).collect()
    assert [(r.genre, r.venue_city) for r in rows] == [("Jazz", "Oslo"), (None, None)]
    assert rows[1].num_observations == 2
    assert rows[0].mean_price == Decimal("2.00") and rows[0].median_price == Decimal("2.00")


def test_decimal_rounding_recipe(spark):
    from seatcast.functions import dec2, round_half_away
    df = spark.createDataFrame([(1.005,), (2.675,), (1.0045,), (-1.005,)], "x double")
    got = df.select(round_half_away("x", 2).alias("r"), dec2("x").alias("d")).collect()
    # scaled binary value, half away from zero (2.675*100 is exactly 267.5)
    assert [r.r for r in got] == [1.0, 2.68, 1.0, -1.0]
    assert [r.d for r in got] == [Decimal("1.01"), Decimal("2.68"), Decimal("1.01"),
                                  Decimal("-1.01")]        # via 3 dp first


def test_price_curves_median_counts_equal_prices(spark):
    from seatcast.functions import rounded_avg
    rows = [("g", "c", 5, p, p, p) for p in [10.0] * 5 + [20.0, 30.0, 40.0]]
    snaps = spark.createDataFrame(rows, "genre string, venue_city string, days_until_event long, "
                                        "avg_price double, min_price double, max_price double")
    (r,) = marts.price_curves(snaps).collect()
    assert (r.num_observations, float(r.median_price), float(r.mean_price)) == (8, 10.0, 17.5)
    means = spark.createDataFrame([(642.29,), (642.3,)], "p double")
    assert means.agg(rounded_avg("p", 2).alias("m")).first().m == 642.3      # an exact tie


def test_prices_must_be_finite(spark):
    import pytest
    snaps = spark.createDataFrame([("g", "c", 5, float("nan"), 1.0, 1.0)],
                                  "genre string, venue_city string, days_until_event long, "
                                  "avg_price double, min_price double, max_price double")
    with pytest.raises(Exception, match="NaN or infinite"):
        marts.price_curves(snaps).collect()
