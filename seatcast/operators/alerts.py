"""Newest-day checks: price-target rules, z-score anomalies, rule marking and
digest lines.

All rules are evaluated in one plan (instead of one query per rule): rules
with an event id join the newest day on event_id; artist rules go through the
gram-indexed contains lookup in ``textmatch`` (no nested-loop join).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (DROP, SPIKE, exact_avg, mid_price, nonblank, py_format_0f,
                         py_str_timestamp, round_binary, z_score)
from .textmatch import cheapest_per_pattern


def newest_day(raw: DataFrame) -> _dt.date | None:
    """The newest snapshot_date of all rows: one small job.  Over the store use
    ``store.newest_day``, which reads folder names only."""
    return raw.agg(F.max("snapshot_date")).first()[0]


def latest_snapshot(raw: DataFrame, day: _dt.date | None) -> DataFrame:
    """Rows of ``day`` (the newest one): a literal filter, so a store opens that
    day's folder alone.  No day, no rows."""
    return raw.filter(F.col("snapshot_date") == F.lit(day).cast("date"))


def active_rules(rules: DataFrame) -> DataFrame:
    return rules.filter(~F.coalesce(F.col("triggered"), F.lit(False)))


def price_alerts(today: DataFrame, rules: DataFrame) -> DataFrame:
    """One trigger row per active rule whose target is met in ``today``, the
    newest day's rows (``latest_snapshot``; write them once, they are read for
    ids, texts and winners).

    * a rule naming an event id (non-empty) looks at that event's row only
      (the id wins when a rule names both);
    * otherwise a rule naming an artist (non-empty) takes the cheapest row
      whose artist contains the text case-insensitively (``%``/``_`` act as
      wildcards) -- cheapest by minimum price, then event id;
    * a hit needs a non-NULL minimum price <= target (inclusive).
    """
    day = today.select(
        "event_id", F.col("name").alias("event_name"), "artist_name", "min_price",
        mid_price().alias("avg_price"), "venue_city", "event_date")
    act = active_rules(rules)
    by_id = act.filter(nonblank("event_id")).select("rule_id", "target_price",
                                                    F.col("event_id").alias("_want"))
    by_artist = act.filter(~nonblank("event_id") & nonblank("artist_name")).select(
        "rule_id", "target_price", F.col("artist_name").alias("_pattern"))

    id_hits = by_id.join(day, by_id["_want"] == day["event_id"]).drop("_want")
    priced_day = day.filter(F.col("min_price").isNotNull())
    artist_best = cheapest_per_pattern(priced_day, "artist_name", by_artist, "_pattern",
                                       "rule_id", ["min_price", "event_id"])
    artist_hits = by_artist.drop("_pattern").join(artist_best, "rule_id")

    hits = id_hits.unionByName(artist_hits)
    return (hits.filter(F.col("min_price").isNotNull()
                        & (F.col("min_price") <= F.col("target_price")))
            .select("rule_id", "target_price", "event_id", "event_name", "artist_name",
                    F.col("min_price").alias("current_price"), "avg_price", "venue_city",
                    py_str_timestamp("event_date").alias("event_date")))


def latest_anomalies(raw: DataFrame, today: DataFrame, threshold: float = 2.0,
                     limit: int | None = 20, min_snapshots: int = 3) -> DataFrame:
    """Newest-day priced rows at least ``threshold`` standard deviations from
    their event's mean over all days (events with >= ``min_snapshots`` priced
    rows and a non-zero deviation), largest |z| first, top ``limit``; None
    gives all of them.

    The statistics aggregate (partial, map-side) to one row per event and join
    the newest day on event_id; AQE broadcasts whichever side is measured
    small at runtime."""
    return anomalies_against(today, price_stats(raw, min_snapshots), threshold, limit)


def price_stats(raw: DataFrame, min_snapshots: int = 3) -> DataFrame:
    """event_id, mean_price, stddev_price over all days, for events with enough
    priced rows and a deviation.  ``state.prices.alert_stats`` gives the same
    without reading the history."""
    priced = raw.filter(F.col("min_price").isNotNull())
    return (priced.groupBy("event_id")
            .agg(exact_avg(mid_price()).alias("mean_price"),
                 F.stddev_samp(mid_price()).alias("stddev_price"),
                 F.count(F.lit(1)).alias("_n"))
            .filter((F.col("_n") >= min_snapshots) & (F.col("stddev_price") > 0))
            .drop("_n"))


def anomalies_against(today: DataFrame, stats: DataFrame, threshold: float = 2.0,
                      limit: int | None = 20) -> DataFrame:
    """``latest_anomalies`` for given statistics."""
    day = today.filter(F.col("min_price").isNotNull()).select(
        "event_id", F.col("name").alias("event_name"), "artist_name", "venue_city",
        mid_price().alias("current_price"))
    z = z_score("current_price", "mean_price", "stddev_price")
    far = (day.join(stats, "event_id")
           .withColumn("z_score", z)
           .filter(F.abs("z_score") >= F.lit(threshold)))
    if limit is not None:
        far = far.orderBy(F.abs("z_score").desc(), F.asc("event_id")).limit(limit)
    return far.select("event_id", "event_name", "artist_name", "venue_city", "current_price",
                      "mean_price", "z_score", round_binary("z_score", 2).alias("z_rounded"),
                      F.when(F.col("z_score") > 0, F.lit(SPIKE)).otherwise(F.lit(DROP))
                      .alias("kind"))


def mark_triggered(rules: DataFrame, hits: DataFrame, as_of: _dt.datetime,
                   compat: bool = False) -> DataFrame:
    """Rules after a check: hit rules get triggered = true, the check time and
    the hit price.

    Default: a hit marks the rule that produced it.  ``compat=True``
    reproduces the original list-scan marking: a hit marks every rule whose
    event id equals the hit rule's event id *or* whose artist equals the hit
    rule's artist, where two missing values count as equal (so an artist-only
    hit marks every rule without an event id), already triggered rules are
    stamped again, and the last hit in rule order sets the price.  That OR of
    two null-safe equalities runs as two equi-joins against hits aggregated
    to one row per key (the last hit per key), never as rule x hit pairs; what
    missing values share is one row, taken as a scalar subquery, so they are
    no join key."""
    stamp = F.lit(as_of.isoformat(sep=" ")).alias("_at")
    if not compat:
        h = hits.select("rule_id", F.lit(True).alias("_hit"),
                        F.col("current_price").alias("_price"))
        marked = rules.join(h, "rule_id", "left")
        hit = F.coalesce(F.col("_hit"), F.lit(False))
    else:
        r = rules.select("rule_id", F.col("event_id").alias("_eid"),
                         F.col("artist_name").alias("_art"))
        h = hits.select("rule_id", "current_price").join(r, "rule_id")

        last = F.max_by(F.struct("rule_id", "current_price"), "rule_id")

        def mark(frame, column, key, name):
            named = h.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(
                last.alias("_named"))
            missing = h.filter(F.col(key).isNull()).agg(last.alias("l")).scalar()
            joined = frame.join(named, F.col(column) == F.col("_k"), "left")
            return joined.withColumn(name, F.when(F.col(column).isNull(), missing)
                                     .otherwise(F.col("_named"))).drop("_k", "_named")

        marked = mark(mark(rules, "event_id", "_eid", "_le"), "artist_name", "_art", "_la")
        last = F.when(F.col("_la").isNull() |
                      (F.col("_le.rule_id") >= F.col("_la.rule_id")), F.col("_le")) \
            .otherwise(F.col("_la"))
        marked = marked.withColumn("_price", last["current_price"]) \
            .withColumn("_hit", F.col("_le").isNotNull() | F.col("_la").isNotNull())
        hit = F.col("_hit")
    marked = marked.select("*", stamp)
    return marked.select(
        "rule_id", "target_price", "created_at",
        F.when(hit, F.lit(True)).otherwise(F.col("triggered")).alias("triggered"),
        "event_id", "artist_name",
        F.when(hit, F.col("_at")).otherwise(F.col("triggered_at")).alias("triggered_at"),
        F.when(hit, F.col("_price")).otherwise(F.col("triggered_price")).alias("triggered_price"))


def rule_status(rules: DataFrame) -> DataFrame:
    """Listing of the rules: target as '$N', identifier (artist, else event
    id, else '?'; an empty artist counts as absent), status and creation day,
    plus the number of active rules on every row."""
    ident = F.coalesce(F.when(nonblank("artist_name"), F.col("artist_name")),
                       F.col("event_id"), F.lit("?"))
    status = F.when(F.coalesce(F.col("triggered"), F.lit(False)), F.lit("TRIGGERED")) \
        .otherwise(F.lit("active"))
    n_active = active_rules(rules).select(F.count(F.lit(1))).scalar()
    return rules.select(
        "rule_id",
        F.concat(F.lit("$"), py_format_0f("target_price")).alias("target"),
        ident.alias("identifier"), status.alias("status"),
        F.coalesce(F.substring("created_at", 1, 10), F.lit("?")).alias("created"),
        n_active.alias("active_rules"))


def price_alert_digest(hits: DataFrame) -> DataFrame:
    """Message rows for the price hits: position 0 is the subject (naming
    the number of hits, from a plain aggregate), then one line per hit in
    rule order (position = rule_id + 1).  No row holds more than one hit."""
    subject = (hits.agg(F.count(F.lit(1)).alias("n"))
               .filter(F.col("n") > 0)
               .select(F.lit("price").alias("section"), F.lit(0).cast("long").alias("position"),
                       F.format_string("Price Alert: %d ticket(s) hit your target!", F.col("n"))
                       .alias("line")))
    line = F.concat(
        F.lit("  "), F.coalesce("artist_name", F.lit("None")), F.lit(" — "),
        F.coalesce("event_name", F.lit("None")), F.lit("\n  Current price: $"),
        py_format_0f("current_price"), F.lit(" (target: $"), py_format_0f("target_price"),
        F.lit(")\n  "), F.coalesce("venue_city", F.lit("None")), F.lit(" | "),
        F.col("event_date"), F.lit("\n"))
    lines = hits.select(F.lit("price").alias("section"),
                        (F.col("rule_id") + 1).alias("position"), line.alias("line"))
    return subject.unionByName(lines)


def anomaly_digest(anomalies: DataFrame, lines_per_kind: int = 10) -> DataFrame:
    """Message rows for the anomalies: an 'anomaly' subject row counting
    drops and spikes of all anomalies, then per kind ('drop', 'spike') its first
    ``lines_per_kind`` lines in |z| order (the rank filter keeps that many rows
    a task before the shuffle)."""
    subject = (anomalies.agg(F.count_if(F.col("kind") == F.lit(DROP)).alias("d"),
                             F.count_if(F.col("kind") == F.lit(SPIKE)).alias("s"))
               .filter(F.col("d") + F.col("s") > 0)
               .select(F.lit("anomaly").alias("section"), F.lit(0).cast("long").alias("position"),
                       F.format_string("Price Anomalies: %d drops, %d spikes detected",
                                       F.col("d"), F.col("s")).alias("line")))
    w = Window.partitionBy("kind").orderBy(F.abs("z_score").desc(), F.asc("event_id"))
    line = F.concat(
        F.lit("  "), F.coalesce("artist_name", F.lit("None")), F.lit(" — $"),
        py_format_0f("current_price"), F.lit(" (avg $"), py_format_0f("mean_price"),
        F.lit(", z="), F.col("z_rounded").cast("string"), F.lit(")"))
    lines = (anomalies.select("*", F.row_number().over(w).cast("long").alias("position"))
             .filter(F.col("position") <= lines_per_kind)
             .select(F.col("kind").alias("section"), "position", line.alias("line")))
    return subject.unionByName(lines)


def alert_digest(hits: DataFrame, anomalies: DataFrame, lines_per_kind: int = 10) -> DataFrame:
    """Both digests as (section, position, line) rows."""
    return price_alert_digest(hits).unionByName(anomaly_digest(anomalies, lines_per_kind))
