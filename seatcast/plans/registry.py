"""Query registry: name -> callable(spark, sf_dir) -> DataFrame.

Every entry reads the driver tables through ``sources.adapter`` (so its work
grows with them) and applies one operator from ``operators``.  Column names
match ``seatcast.oracle``; float aggregates are passed through
``functions.stable`` where the last bits depend on the summation order.
The ingestion entries land pages and build stores in fresh folders under the
session's checkpoint folder before returning the lazy read of the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stable
from ..operators import alerts, marts, reports, staging
from ..schemas import API_EVENT
from ..session import scratch_path, write_scratch
from ..sources import adapter, bucketed, pages, store
from ..sources.rules import rules_frame
from ..state import history, prices
from . import build, daily
from . import params as P

Query = Callable[[SparkSession, str], DataFrame]

NO_EXPORT = ["url", "ingested_at"]


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.snapshots(spark, sf_dir)


def _snaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.price_snapshots(staging.stg_events(_raw(spark, sf_dir)))


def _stable(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: stable(c) for c in cols})


def q_snapshots(spark, sf_dir):
    return _raw(spark, sf_dir).drop(*NO_EXPORT)


def q_stg_events(spark, sf_dir):
    return staging.stg_events(_raw(spark, sf_dir)).drop(*NO_EXPORT)


def q_price_snapshots(spark, sf_dir):
    return _snaps(spark, sf_dir)


def q_price_curves(spark, sf_dir):
    return marts.price_curves(_snaps(spark, sf_dir))


def q_best_buy_windows(spark, sf_dir):
    return marts.best_buy_windows(_snaps(spark, sf_dir))


def q_soldout_velocity(spark, sf_dir):
    return marts.soldout_velocity(_snaps(spark, sf_dir))


def q_event_stats(spark, sf_dir):
    return _stable(marts.event_stats(_snaps(spark, sf_dir)), "mean_price", "stddev_price")


def q_price_anomalies(spark, sf_dir):
    return _stable(marts.price_anomalies(_snaps(spark, sf_dir)), "mean_price", "stddev_price")


# ------------------------------------------------------------------ alerts

def _rules(spark):
    return rules_frame(spark, P.RULES)


def _today(spark, sf_dir):
    """The newest day's rows, written once: every alert query reads them."""
    return write_scratch(alerts.latest_snapshot(_raw(spark, sf_dir),
                                                adapter.newest_day(spark, sf_dir)), "newest-day")


def q_latest_snapshot(spark, sf_dir):
    return alerts.latest_snapshot(_raw(spark, sf_dir),
                                  adapter.newest_day(spark, sf_dir)).drop(*NO_EXPORT)


def _hits(spark, sf_dir, today=None):
    return alerts.price_alerts(_today(spark, sf_dir) if today is None else today, _rules(spark))


def q_price_alerts(spark, sf_dir):
    return _hits(spark, sf_dir)


def _latest_anomalies(spark, sf_dir, today, limit=P.ANOMALY_ALERT_LIMIT):
    return alerts.latest_anomalies(_raw(spark, sf_dir), today, P.Z_THRESHOLD, limit,
                                   P.MIN_SNAPSHOTS)


def q_latest_anomalies(spark, sf_dir):
    today = alerts.latest_snapshot(_raw(spark, sf_dir), adapter.newest_day(spark, sf_dir))
    return _stable(_latest_anomalies(spark, sf_dir, today), "current_price", "mean_price",
                   "z_score")


def q_mark_triggered(spark, sf_dir):
    hits = write_scratch(_hits(spark, sf_dir), "hits")
    return alerts.mark_triggered(_rules(spark), hits, P.AS_OF)


def q_mark_triggered_compat(spark, sf_dir):
    hits = write_scratch(_hits(spark, sf_dir), "hits")
    return alerts.mark_triggered(_rules(spark), hits, P.AS_OF, compat=True)


def q_alert_digest(spark, sf_dir):
    today = _today(spark, sf_dir)
    hits = write_scratch(_hits(spark, sf_dir, today), "hits")
    far = write_scratch(_latest_anomalies(spark, sf_dir, today, limit=None), "anomalies")
    return alerts.alert_digest(hits, far, P.DIGEST_LINES_PER_KIND)


# ------------------------------------------------------------------ reports

def q_row_count(spark, sf_dir):
    return reports.row_count(_raw(spark, sf_dir))


def q_kpi_summary(spark, sf_dir):
    return reports.kpi_summary(_raw(spark, sf_dir))


def q_filter_values(spark, sf_dir):
    return reports.filter_values(_raw(spark, sf_dir))


def q_curve_report(spark, sf_dir):
    return reports.curve_report(_raw(spark, sf_dir))


def q_curve_report_filtered(spark, sf_dir):
    return reports.curve_report(_raw(spark, sf_dir), P.GENRE, P.CITY)


def q_curve_summary(spark, sf_dir):
    return reports.curve_summary(reports.curve_report(_raw(spark, sf_dir)))


def q_sellout_report(spark, sf_dir):
    return reports.sellout_report(_raw(spark, sf_dir), limit=P.SELLOUT_LIMIT)


def q_sellout_report_filtered(spark, sf_dir):
    return reports.sellout_report(_raw(spark, sf_dir), P.GENRE, P.CITY, limit=P.SELLOUT_LIMIT)


def q_sellout_top15(spark, sf_dir):
    return reports.sellout_table(_raw(spark, sf_dir), rows=P.SELLOUT_TABLE_ROWS)


def q_sellout_summary(spark, sf_dir):
    return reports.sellout_summary(reports.sellout_report(_raw(spark, sf_dir), limit=None))


def q_sellout_histogram(spark, sf_dir):
    return reports.sellout_histogram(
        reports.sellout_report(_raw(spark, sf_dir), limit=None), P.HISTOGRAM_MAX_BINS)


def q_weekday_report(spark, sf_dir):
    return reports.weekday_report(_raw(spark, sf_dir), min_observations=P.MIN_OBSERVATIONS)


def q_weekday_report_filtered(spark, sf_dir):
    return reports.weekday_report(_raw(spark, sf_dir), P.GENRE, P.CITY,
                                  min_observations=P.MIN_OBSERVATIONS)


def q_weekday_summary(spark, sf_dir):
    return reports.weekday_summary(reports.weekday_report(_raw(spark, sf_dir)))


def q_event_explorer(spark, sf_dir):
    return reports.event_explorer(_raw(spark, sf_dir), P.AS_OF)


def q_event_explorer_search(spark, sf_dir):
    return reports.event_explorer(_raw(spark, sf_dir), P.AS_OF, search=P.SEARCH)


def q_explorer_page(spark, sf_dir):
    return reports.explorer_page(_raw(spark, sf_dir), P.AS_OF, rows=P.EXPLORER_PAGE_ROWS)


def q_explorer_summary(spark, sf_dir):
    return _stable(reports.explorer_summary(reports.event_explorer(_raw(spark, sf_dir), P.AS_OF)),
                   "avg_min_price", "avg_max_price")


def _anomaly_report(spark, sf_dir, genre=None, city=None, limit=P.ANOMALY_REPORT_LIMIT):
    return reports.anomaly_report(_raw(spark, sf_dir), genre, city, P.Z_THRESHOLD, limit,
                                  P.MIN_SNAPSHOTS)


def q_anomaly_report(spark, sf_dir):
    return _stable(_anomaly_report(spark, sf_dir), "mean_price", "stddev_price", "z_score")


def q_anomaly_report_filtered(spark, sf_dir):
    return _stable(_anomaly_report(spark, sf_dir, P.GENRE, P.CITY),
                   "mean_price", "stddev_price", "z_score")


def q_anomaly_chart(spark, sf_dir):
    return _stable(reports.anomaly_chart(_anomaly_report(spark, sf_dir)), "z_score")


def q_anomaly_summary(spark, sf_dir):
    return _stable(reports.anomaly_summary(_anomaly_report(spark, sf_dir, limit=None)),
                   "best_deal_mean_price", "best_deal_z_score")


# ------------------------------------------------------------------ ingestion

INGEST_COLUMNS = pages.FLAT_COLUMNS + ["snapshot_date"]


def q_flatten_events(spark, sf_dir):
    """Snapshot rows -> API event JSON text -> parsed -> flattened."""
    nested = pages.nest_events(_raw(spark, sf_dir))
    parsed = nested.select("snapshot_date",
                           F.from_json(F.to_json("event"), API_EVENT).alias("event"))
    return pages.flatten_events(parsed).select(*INGEST_COLUMNS)


def q_flatten_nulls(spark, sf_dir):
    """The same through VARIANT.  Events on offer have no key for what is NULL and none
    for the sub-genre; sold-out ones hold explicit nulls there."""
    nested = pages.nest_events(_raw(spark, sf_dir))
    sold_out = F.col("event.dates.status.code") == "offsale"
    event = F.col("event").withField("classifications", F.transform(
        "event.classifications", lambda c: c.withField(
            "subGenre", c["subGenre"].withField("name", F.lit(None).cast("string")))))
    text = F.when(sold_out, F.to_json(event, {"ignoreNullFields": "false"})).otherwise(
        F.to_json(event))
    parsed = nested.select("snapshot_date", F.try_parse_json(text).alias("event"))
    return pages.flatten_events(parsed).select(*INGEST_COLUMNS)


def _landed(spark, sf_dir):
    root = scratch_path(spark, "landing")
    pages.land_pages(_raw(spark, sf_dir), root)
    return root


def q_ingest_pages(spark, sf_dir):
    """Land the rows as result pages, read them back with the fetch rules."""
    return pages.landed_rows(spark, _landed(spark, sf_dir)).select(*INGEST_COLUMNS)


def q_snapshot_store(spark, sf_dir):
    """Landed pages -> key check -> replace-day upsert -> read the store."""
    root = _landed(spark, sf_dir)
    path = scratch_path(spark, "store")
    build.ingest_landed(spark, root, path, ingested_at=P.AS_OF)
    return store.read_store(spark, path).select(*INGEST_COLUMNS)


def q_stream_ingest(spark, sf_dir):
    """The same through the streaming ingest (available-now trigger)."""
    from ..streaming.ingest import start_ingest_stream
    root = _landed(spark, sf_dir)
    path = scratch_path(spark, "stream-store")
    q = start_ingest_stream(spark, root, path, scratch_path(spark, "stream-ckpt"),
                            ingested_at=P.AS_OF)
    q.awaitTermination()
    return store.read_store(spark, path).select(*INGEST_COLUMNS)


# ------------------------------------------------------------------ kept state

def _kept(spark, sf_dir, *parts):
    """A store and the state kept beside it, after three daily jobs: all days but the
    newest, of which a middle one has wrong prices and lacks rows; that day again, now
    right; the newest day."""
    raw = write_scratch(_raw(spark, sf_dir), "raw")
    days = sorted(r[0] for r in raw.select("snapshot_date").distinct().collect())
    newest, middle = days[-1], days[len(days) // 2]
    path, state = scratch_path(spark, "kept-store"), scratch_path(spark, "kept-state")

    def job(rows):
        done = store.upsert_days(rows, path, ingested_at=P.AS_OF)
        daily.refresh(spark, path, state, done["replaced"], parts)

    day = F.col("snapshot_date")
    wrong = raw.filter((day == middle) & (F.crc32("event_id") % 3 != 0)).withColumns(
        {c: F.col(c) * 2 + 1 for c in ("min_price", "max_price")})
    job(raw.filter((day != newest) & (day != middle)).unionByName(wrong))
    job(raw.filter(day == middle))
    job(raw.filter(day == newest))
    return path, state


def q_event_stats_kept(spark, sf_dir):
    _, state = _kept(spark, sf_dir, prices.MOMENTS.name)
    return _stable(prices.event_stats(daily.kept(spark, state, prices.MOMENTS)),
                   "mean_price", "stddev_price")


def q_latest_anomalies_kept(spark, sf_dir):
    path, state = _kept(spark, sf_dir, prices.MOMENTS.name)
    return _stable(daily.newest_anomalies(spark, path, state, P.Z_THRESHOLD,
                                          P.ANOMALY_ALERT_LIMIT, P.MIN_SNAPSHOTS),
                   "current_price", "mean_price", "z_score")


def q_price_curves_kept(spark, sf_dir):
    _, state = _kept(spark, sf_dir, prices.PRICE_COUNTS.name)
    return prices.price_curves(daily.kept(spark, state, prices.PRICE_COUNTS))


def q_curve_report_kept(spark, sf_dir):
    _, state = _kept(spark, sf_dir, prices.PRICE_COUNTS.name)
    return prices.curve_report(daily.kept(spark, state, prices.PRICE_COUNTS))


def q_best_buy_windows_kept(spark, sf_dir):
    _, state = _kept(spark, sf_dir, prices.WEEKDAYS.name)
    return prices.best_buy_windows(daily.kept(spark, state, prices.WEEKDAYS))


def q_price_snapshots_kept(spark, sf_dir):
    _, state = _kept(spark, sf_dir, daily.HISTORY)
    return history.read(spark, f"{state}/{daily.HISTORY}")


def q_stream_complete_days(spark, sf_dir):
    """Pages staged once by one stream; days released whole by another."""
    from ..streaming.complete import release_days, stage_pages
    root, work = _landed(spark, sf_dir), scratch_path(spark, "stream-work")
    path = scratch_path(spark, "complete-store")
    stage_pages(spark, root, work, staged_at=P.AS_OF).awaitTermination()
    release_days(spark, work, path, ingested_at=P.AS_OF).awaitTermination()
    return store.read_store(spark, path).select(*INGEST_COLUMNS)


def _bucketed(spark, sf_dir, buckets=8):
    """The rows in a table bucketed by event, filled by two daily jobs."""
    path = scratch_path(spark, "bucketed")
    table = path.rpartition("/")[2].replace("-", "_")
    raw = write_scratch(_raw(spark, sf_dir), "raw")
    days = sorted(r[0] for r in raw.select("snapshot_date").distinct().collect())
    bucketed.create(spark, table, path, buckets)
    for part in (days[:-1], days[-1:]):
        bucketed.replace_days(raw, table, part)
    return bucketed.read(spark, table)


def q_price_anomalies_bucketed(spark, sf_dir):
    snaps = staging.price_snapshots(staging.stg_events(_bucketed(spark, sf_dir)))
    return _stable(marts.price_anomalies(snaps), "mean_price", "stddev_price")


def q_duplicate_keys(spark, sf_dir):
    """Repeats of a coarser key than the store's own, which never repeats."""
    return store.duplicate_keys(_raw(spark, sf_dir), key=P.DUPLICATE_KEY)


def queries() -> dict[str, Query]:
    return {
        "snapshots": q_snapshots,
        "stg_events": q_stg_events,
        "price_snapshots": q_price_snapshots,
        "price_curves": q_price_curves,
        "best_buy_windows": q_best_buy_windows,
        "soldout_velocity": q_soldout_velocity,
        "event_stats": q_event_stats,
        "price_anomalies": q_price_anomalies,
        "latest_snapshot": q_latest_snapshot,
        "price_alerts": q_price_alerts,
        "latest_anomalies": q_latest_anomalies,
        "mark_triggered": q_mark_triggered,
        "mark_triggered_compat": q_mark_triggered_compat,
        "alert_digest": q_alert_digest,
        "row_count": q_row_count,
        "kpi_summary": q_kpi_summary,
        "filter_values": q_filter_values,
        "curve_report": q_curve_report,
        "curve_report_filtered": q_curve_report_filtered,
        "curve_summary": q_curve_summary,
        "sellout_report": q_sellout_report,
        "sellout_report_filtered": q_sellout_report_filtered,
        "sellout_top15": q_sellout_top15,
        "sellout_summary": q_sellout_summary,
        "sellout_histogram": q_sellout_histogram,
        "weekday_report": q_weekday_report,
        "weekday_report_filtered": q_weekday_report_filtered,
        "weekday_summary": q_weekday_summary,
        "event_explorer": q_event_explorer,
        "event_explorer_search": q_event_explorer_search,
        "explorer_page": q_explorer_page,
        "explorer_summary": q_explorer_summary,
        "anomaly_report": q_anomaly_report,
        "anomaly_report_filtered": q_anomaly_report_filtered,
        "anomaly_chart": q_anomaly_chart,
        "anomaly_summary": q_anomaly_summary,
        "flatten_events": q_flatten_events,
        "flatten_nulls": q_flatten_nulls,
        "ingest_pages": q_ingest_pages,
        "snapshot_store": q_snapshot_store,
        "stream_ingest": q_stream_ingest,
        "duplicate_keys": q_duplicate_keys,
        "stream_complete_days": q_stream_complete_days,
        "event_stats_kept": q_event_stats_kept,
        "latest_anomalies_kept": q_latest_anomalies_kept,
        "price_curves_kept": q_price_curves_kept,
        "curve_report_kept": q_curve_report_kept,
        "best_buy_windows_kept": q_best_buy_windows_kept,
        "price_snapshots_kept": q_price_snapshots_kept,
        "price_anomalies_bucketed": q_price_anomalies_bucketed,
    }
