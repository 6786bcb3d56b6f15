"""Whole jobs: build the marts, ingest landed pages, run the alert check."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import alerts, marts, staging
from ..session import write_scratch
from ..sources import pages, rules as rules_io, store

MARTS = {
    "price_curves": marts.price_curves,
    "best_buy_windows": marts.best_buy_windows,
    "soldout_velocity": marts.soldout_velocity,
    "price_anomalies": marts.price_anomalies,
}


def build_marts(raw: DataFrame, out_dir: str, *, names=None,
                stage_history: bool = False) -> dict[str, str]:
    """Rebuild every mart in full (overwrite) under ``out_dir/<name>``.

    By default each mart is its own plan over ``raw``: Catalyst prunes the
    columns (and, where unused, the history window) per mart, so over the
    Parquet store each mart reads only what it needs and aggregates
    map-side.  Nothing caches the whole history (at scale that would be a
    full copy on executor disks).  For an expensive ``raw`` (a derived
    relation rather than the store) ``stage_history=True`` writes the history
    once to ``out_dir/_history`` and builds the marts from that table -- a
    lineage cut in shared storage that survives lost executors."""
    snaps = staging.price_snapshots(staging.stg_events(raw))
    if stage_history:
        path = f"{out_dir.rstrip('/')}/_history"
        snaps.write.mode("overwrite").parquet(path)
        snaps = raw.sparkSession.read.parquet(path)
    out = {}
    for name, fn in MARTS.items():
        if names and name not in names:
            continue
        path = f"{out_dir.rstrip('/')}/{name}"
        fn(snaps).write.mode("overwrite").parquet(path)
        out[name] = path
    return out


class BadLandingError(ValueError):
    pass


def ingest_landed(spark: SparkSession, landing_root: str, store_path: str, *,
                  days: list[_dt.date] | None = None, dedupe: bool = False,
                  strict: bool = False, as_of: _dt.datetime | None = None,
                  days_ahead: int = 90, city: str | None = None, state: str | None = None,
                  genre: str | None = None, max_pages: int | None = None,
                  ingested_at: _dt.datetime | None = None, keep_nulls: bool = False,
                  on_replaced: Callable[[list[_dt.date]], None] | None = None) -> dict:
    """Daily ingestion: landed pages -> flat rows -> key check -> replace the
    days in the store.  ``days`` restricts (and guarantees) the replaced
    days: a listed day without rows is emptied.  ``as_of`` and the filters
    after it keep the events the search asked for (``pages.event_window``).

    Returns counters: pages, repeats, unreadable lines, missing pages, events
    fetched, rows written, rejected dates, days.  ``strict`` raises
    ``BadLandingError`` before writing if lines are unreadable or pages miss.
    ``keep_nulls`` stores an explicit null text as NULL, not as the default.
    ``on_replaced`` gets the replaced days, for what is kept between days
    (``plans.daily.refresh``)."""
    report = pages.page_report(pages.read_pages(spark, landing_root, days))
    names = ["pages", "repeats", "unreadable", "missing", "events"]
    found = report.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first().asDict()
    if strict and (found["unreadable"] or found["missing"]):
        raise BadLandingError(f"{found['unreadable']} unreadable lines and {found['missing']} "
                              f"missing pages under {landing_root}")
    rows = pages.landed_rows(spark, landing_root, days, max_pages, keep_nulls)
    if as_of is not None:
        rows = pages.event_window(rows, as_of, days_ahead, city=city, state=state, genre=genre)
    done = store.upsert_days(rows, store_path, days=days, dedupe=dedupe, ingested_at=ingested_at)
    replaced = done.pop("replaced")
    if on_replaced is not None and replaced:
        on_replaced(replaced)
    return found | done


def run_alert_check(spark: SparkSession, raw: DataFrame, rules_path: str, *,
                    save_to: str | None, as_of: _dt.datetime, day: _dt.date | None = None,
                    compat: bool = False, threshold: float = 2.0,
                    limit: int = 20) -> dict[str, DataFrame]:
    """The alert job: price hits, anomaly list, digests and the marked rules.

    ``day`` is the newest day if the caller knows it (``store.newest_day`` reads
    folder names only).  The newest day's rows and the hits are written once to
    the shared scratch folder.  The marked rules are written to ``save_to`` (a
    new path; never the file that was read) only when there is a hit and
    ``save_to`` is given (a dry run passes None)."""
    rules = rules_io.read_rules(spark, rules_path)
    day = day or alerts.newest_day(raw)
    today = write_scratch(alerts.latest_snapshot(raw, day), "newest-day")
    hits = write_scratch(alerts.price_alerts(today, rules), "hits")
    far = write_scratch(alerts.latest_anomalies(raw, today, threshold, None), "anomalies")
    marked = alerts.mark_triggered(rules, hits, as_of, compat=compat)
    if save_to is not None and not hits.isEmpty():
        rules_io.save_rules(marked, save_to)
    listed = far.orderBy(F.abs("z_score").desc(), F.asc("event_id")).limit(limit)
    return {"hits": hits, "anomalies": listed, "rules": marked,
            "digest": alerts.alert_digest(hits, far)}
