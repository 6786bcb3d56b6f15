"""Command line for the daily jobs (each one Spark job chain, no driver loops).

    python -m seatcast ingest --landing L --store S [--day YYYY-MM-DD ...] [--dedupe]
                              [--strict] [--as-of T [--days-ahead N]] [--city C] [--venue-state S]
                              [--genre G] [--state D] [--keep-nulls]
    python -m seatcast stream --landing L --store S --checkpoint C [--every "1 hour"]
                              [--dedupe] [--files-per-trigger N]
    python -m seatcast stream --landing L --store S --work W [--patience "12 hours"]
                              [--dedupe] [--files-per-trigger N] [--state D]
    python -m seatcast build-marts --store S --out O [--stage-history | --state D]
    python -m seatcast check-alerts --store S --rules R [--save-to NEW] [--dry-run]
                                    [--as-of "YYYY-MM-DD HH:MM:SS"] [--compat] [--state D]
    python -m seatcast rules --rules R

The session comes from ``spark-submit`` / the cluster configuration; run
locally it falls back to ``local[*]``.  With ``--state`` the totals and the history kept
in that folder are brought up to date (ingest, stream) or read in place of the whole
store (build-marts, check-alerts).  ``stream --work`` stages pages once and stores days
when they are complete.  Output is printed with ``show``
(bounded: digests and rule listings are small by construction).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    spark = SparkSession.getActiveSession()
    if spark is None:
        from pyspark import SparkConf
        builder = SparkSession.builder.appName("seatcast")
        if not SparkConf().contains("spark.master"):
            from .session import BASE_CONF
            builder = builder.master("local[*]")
            for k, v in BASE_CONF.items():
                builder = builder.config(k, v)
        spark = builder.getOrCreate()
    return spark


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="seatcast")
    sub = p.add_subparsers(dest="cmd", required=True)

    ing = sub.add_parser("ingest", help="landed pages -> replace days in the store")
    ing.add_argument("--landing", required=True)
    ing.add_argument("--store", required=True)
    ing.add_argument("--day", action="append", default=[])
    ing.add_argument("--dedupe", action="store_true")
    ing.add_argument("--strict", action="store_true", help="fail on unreadable or missing pages")
    ing.add_argument("--as-of", default=None, help="keep events from this time on")
    ing.add_argument("--days-ahead", type=int, default=90)
    for name in ("city", "venue-state", "genre"):
        ing.add_argument(f"--{name}", default=None)

    ing.add_argument("--keep-nulls", action="store_true",
                     help="explicit null texts stay NULL; only missing keys get the default")
    st = sub.add_parser("stream", help="incremental ingest of newly landed pages")
    st.add_argument("--landing", required=True)
    st.add_argument("--store", required=True)
    st.add_argument("--checkpoint", default=None)
    st.add_argument("--work", default=None, help="stage pages here, store complete days")
    st.add_argument("--patience", default="12 hours")
    st.add_argument("--dedupe", action="store_true")
    st.add_argument("--files-per-trigger", type=int, default=None)
    st.add_argument("--every", default=None, help="poll interval; default: process and stop")

    bm = sub.add_parser("build-marts", help="rebuild the four marts from the store")
    bm.add_argument("--store", required=True)
    bm.add_argument("--out", required=True)
    bm.add_argument("--stage-history", action="store_true")

    ca = sub.add_parser("check-alerts", help="price targets and anomalies on the newest day")
    ca.add_argument("--store", required=True)
    ca.add_argument("--rules", required=True)
    ca.add_argument("--save-to", default=None, help="new path for the marked rules")
    ca.add_argument("--dry-run", action="store_true")
    ca.add_argument("--as-of", default=None)
    ca.add_argument("--compat", action="store_true")

    for job in (ing, st, bm, ca):
        job.add_argument("--state", default=None, help="folder of the kept state")

    rl = sub.add_parser("rules", help="list the alert rules")
    rl.add_argument("--rules", required=True)

    a = p.parse_args(argv)
    spark = _session()
    from .plans import build, daily
    from .sources import rules as rules_io
    from .sources import store as store_io

    if a.cmd == "ingest":
        days = [dt.date.fromisoformat(d) for d in a.day] or None
        if a.as_of is None and (a.city or a.venue_state or a.genre):
            p.error("--city, --venue-state and --genre need --as-of")
        refresh = (lambda days: daily.refresh(spark, a.store, a.state, days)) if a.state else None
        print(build.ingest_landed(
            spark, a.landing, a.store, days=days, dedupe=a.dedupe, strict=a.strict,
            as_of=dt.datetime.fromisoformat(a.as_of) if a.as_of else None,
            days_ahead=a.days_ahead, city=a.city, state=a.venue_state, genre=a.genre,
            keep_nulls=a.keep_nulls,
            on_replaced=refresh))
    elif a.cmd == "stream" and a.work:
        from .streaming.complete import release_days, stage_pages
        how = {"available_now": a.every is None, "processing_time": a.every,
               "files_per_trigger": a.files_per_trigger}
        staging = stage_pages(spark, a.landing, a.work, **how)
        if a.every is None:
            staging.awaitTermination()
        else:  # the first pages must be there before the second stream starts
            staging.processAllAvailable()
        release_days(spark, a.work, a.store, patience=a.patience, dedupe=a.dedupe,
                     on_release=(lambda days: daily.refresh(spark, a.store, a.state, days))
                     if a.state else None, **how).awaitTermination()
    elif a.cmd == "stream":
        if not a.checkpoint:
            p.error("stream needs --checkpoint or --work")
        from .streaming.ingest import start_ingest_stream
        q = start_ingest_stream(spark, a.landing, a.store, a.checkpoint,
                                available_now=a.every is None, processing_time=a.every,
                                dedupe=a.dedupe, files_per_trigger=a.files_per_trigger)
        q.awaitTermination()
    elif a.cmd == "build-marts":
        raw = store_io.read_store(spark, a.store)
        print(daily.build_marts(spark, a.state, a.out) if a.state else
              build.build_marts(raw, a.out, stage_history=a.stage_history))
    elif a.cmd == "check-alerts":
        as_of = dt.datetime.fromisoformat(a.as_of) if a.as_of else dt.datetime.now()
        how = {"save_to": None if a.dry_run else a.save_to, "as_of": as_of, "compat": a.compat}
        if a.state:
            out = daily.check_alerts(spark, a.store, a.state, a.rules, **how)
        else:
            out = build.run_alert_check(spark, store_io.read_store(spark, a.store), a.rules,
                                        day=store_io.newest_day(spark, a.store), **how)
        out["digest"].orderBy("section", "position").show(truncate=False)
    elif a.cmd == "rules":
        from .operators.alerts import rule_status
        rule_status(rules_io.read_rules(spark, a.rules)).orderBy("rule_id").show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
