"""The table bucketed by event: plans without an exchange, replaced days."""

import uuid

import pytest

from conftest import d, snap
from seatcast.operators import marts, staging
from seatcast.session import write_scratch
from seatcast.sources import adapter, bucketed

SF = "/root/testdata/sf0.001"


@pytest.fixture
def table(spark, tmp_path):
    name = f"bucketed_{uuid.uuid4().hex}"
    bucketed.create(spark, name, str(tmp_path / "it's"), 4)
    yield name
    spark.sql(f"DROP TABLE {name}")


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def history(raw):
    return staging.price_snapshots(staging.stg_events(raw))


def test_window_statistics_and_join_need_no_exchange(spark, table):
    raw = write_scratch(adapter.snapshots(spark, SF), "raw")
    bucketed.replace_days(raw, table, [r[0] for r in raw.select("snapshot_date").distinct()
                                       .collect()])
    own, threshold = bucketed.read(spark, table), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        for made in (history, lambda r: marts.event_stats(history(r)),
                     lambda r: marts.price_anomalies(history(r))):
            text = made(own)._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in text and "Bucketed: true" in text, text
            assert "Exchange" in made(raw)._jdf.queryExecution().executedPlan().toString()
        same(marts.event_stats(history(own)).select("event_id", "num_snapshots"),
             marts.event_stats(history(raw)).select("event_id", "num_snapshots"))
    finally:
        spark.conf.set(threshold, before)
    same(history(own), history(raw))


def test_replaced_thinned_and_emptied_days(spark, raw_df, table, tmp_path):
    def rows(*prices):
        return raw_df([snap(f"e{i}", day, p, p + 1) for day, p in prices for i in range(9)])

    bucketed.replace_days(rows(("2024-01-01", 5.0), ("2024-01-02", 6.0), ("2024-01-03", 7.0)),
                          table, [d("2024-01-01"), d("2024-01-02"), d("2024-01-03")])
    files = sorted((tmp_path / "it's").rglob("*.parquet"))
    assert len(files) <= 3 * 4
    # another day's rows in the batch are left alone; a listed day without rows goes
    bucketed.replace_days(rows(("2024-01-02", 8.0), ("2024-01-03", 1.0)).where("event_id < 'e4'"),
                          table, [d("2024-01-01"), d("2024-01-02")])
    got = bucketed.read(spark, table)
    assert got.groupBy("snapshot_date", "min_price").count().count() == 2
    same(got, rows(("2024-01-02", 8.0)).where("event_id < 'e4'").unionByName(
        rows(("2024-01-03", 7.0))))
    kept = [f for f in files if "2024-01-03" in str(f)]
    assert kept and all(f.exists() for f in kept)
    bucketed.replace_days(got.limit(0), table, [])
    assert got.count() == 13
