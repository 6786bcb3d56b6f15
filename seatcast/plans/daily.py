"""The daily job on kept state: what was replaced in the store goes into the totals and
the history, and statistics, curves and alerts are read from there."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import alerts, marts
from ..session import write_scratch
from ..sources import rules as rules_io, store
from ..state import history, prices, totals

HISTORY = "history"


def refresh(spark: SparkSession, store_path: str, state: str, days: list[_dt.date],
            parts=(*(t.name for t in prices.TOTALS), HISTORY)) -> None:
    """Bring everything kept below ``state`` up to date after ``days`` were replaced in
    the store (``upsert_days`` returns them).  Reads those days' rows, and for the
    history also the days after them."""
    if not days:
        return
    state = state.rstrip("/")
    rows = store.read_store(spark, store_path)
    for total in prices.TOTALS:
        if total.name in parts:
            totals.update(spark, total, f"{state}/{total.name}", rows, days)
    if HISTORY in parts:
        history.update(spark, store_path, f"{state}/{HISTORY}", days)


def kept(spark: SparkSession, state: str, total: totals.Total) -> DataFrame:
    found = totals.read(spark, f"{state.rstrip('/')}/{total.name}")
    if found is None:
        raise FileNotFoundError(f"no {total.name} below {state}: run refresh first")
    return found


def newest_anomalies(spark: SparkSession, store_path: str, state: str, threshold: float = 2.0,
                     limit: int | None = 20, min_snapshots: int = 3) -> DataFrame:
    """``alerts.latest_anomalies`` from the newest day's folder and the moments."""
    day = store.newest_day(spark, store_path)
    today = alerts.latest_snapshot(store.read_store(spark, store_path), day)
    stats = prices.alert_stats(kept(spark, state, prices.MOMENTS), min_snapshots=min_snapshots)
    return alerts.anomalies_against(today, stats, threshold, limit)


def check_alerts(spark: SparkSession, store_path: str, state: str, rules_path: str, *,
                 save_to: str | None, as_of: _dt.datetime, compat: bool = False,
                 threshold: float = 2.0, limit: int = 20) -> dict[str, DataFrame]:
    """``build.run_alert_check`` without reading the history."""
    rules = rules_io.read_rules(spark, rules_path)
    day = store.newest_day(spark, store_path)
    today = write_scratch(alerts.latest_snapshot(store.read_store(spark, store_path), day),
                          "newest-day")
    hits = write_scratch(alerts.price_alerts(today, rules), "hits")
    stats = prices.alert_stats(kept(spark, state, prices.MOMENTS))
    far = write_scratch(alerts.anomalies_against(today, stats, threshold, None), "anomalies")
    marked = alerts.mark_triggered(rules, hits, as_of, compat=compat)
    if save_to is not None and not hits.isEmpty():
        rules_io.save_rules(marked, save_to)
    listed = far.orderBy(F.abs("z_score").desc(), F.asc("event_id")).limit(limit)
    return {"hits": hits, "anomalies": listed, "rules": marked,
            "digest": alerts.alert_digest(hits, far)}


def build_marts(spark: SparkSession, state: str, out_dir: str) -> dict[str, str]:
    """The four marts from kept state: curves and weekdays from the totals, anomalies
    from the history and the moments; sell-outs from the history's narrow columns."""
    snaps = history.read(spark, f"{state.rstrip('/')}/{HISTORY}")
    stats = prices.event_stats(kept(spark, state, prices.MOMENTS))
    made = {
        "price_curves": prices.price_curves(kept(spark, state, prices.PRICE_COUNTS)),
        "best_buy_windows": prices.best_buy_windows(kept(spark, state, prices.WEEKDAYS)),
        "soldout_velocity": marts.soldout_velocity(snaps),
        "price_anomalies": marts.anomalies_against(snaps, stats),
    }
    out = {}
    for name, rows in made.items():
        out[name] = f"{out_dir.rstrip('/')}/{name}"
        rows.write.mode("overwrite").parquet(out[name])
    return out
