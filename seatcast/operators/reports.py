"""Report queries over the raw snapshots (the explorer/report side).

These follow the report rules, which differ from the marts on purpose:
``min_price IS NOT NULL`` instead of ``avg_price`` (so a row with a minimum
but no maximum is counted but not averaged), DOUBLE rounding instead of
DECIMAL, 'Day of' as the last bucket label, coarser groupings.

Optional ``genre`` / ``city`` / ``search`` parameters are bound as literals
(never spliced into SQL text).  Summaries take the relation they summarise and
stay lazy: the whole one, not the first rows that a list shows.  ``limit``
belongs to the lists; ``limit=None`` gives the whole relation.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (DROP, REPORT_LAST_LABEL, SPIKE, anomaly_type, bucket_order,
                         days_between, days_bucket, exact_avg, exact_median, mid_price,
                         ntz_literal, round_half_away, rounded_avg, weekday_name,
                         weekday_number, z_score)


def filtered(raw: DataFrame, genre: str | None = None, city: str | None = None) -> DataFrame:
    if genre is not None:
        raw = raw.filter(F.col("genre") == F.lit(genre))
    if city is not None:
        raw = raw.filter(F.col("venue_city") == F.lit(city))
    return raw


def contains_pattern(text: str) -> str:
    """'%text%' for LIKE, with backslashes made literal (no escape character
    in the original engine)."""
    return "%" + text.replace("\\", "\\\\") + "%"


def _ordered_first(value, *order, where=None):
    """Value of the first row in ``order`` (ascending; NULL keys skipped)."""
    key = F.struct(*order)
    if where is not None:
        key = F.when(where, key)
    return F.min_by(value, key)


# ------------------------------------------------------------------ headline

def row_count(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count(F.lit(1)).alias("n"))


def kpi_summary(raw: DataFrame) -> DataFrame:
    """Distinct events / artists / days, rounded mean mid price and lowest
    minimum, newest day; priced rows only.  One row; NULL prices when nothing
    is priced (no error).  Catalyst expands the three distinct counts into one
    aggregation pass (Expand + two-level hash aggregate)."""
    priced = raw.filter(F.col("min_price").isNotNull())
    return priced.agg(
        F.count_distinct("event_id").alias("total_events"),
        F.count_distinct("artist_name").alias("total_artists"),
        F.count_distinct("snapshot_date").alias("days_tracked"),
        rounded_avg(mid_price(), 0).alias("avg_price"),
        round_half_away(F.min("min_price"), 0).alias("lowest_price"),
        F.max("snapshot_date").alias("last_updated"),
    )


def filter_values(raw: DataFrame) -> DataFrame:
    """Pick-list values: distinct non-NULL genres and cities (empty strings
    included) as (kind, value), sorted.  One scan feeds both lists."""
    pairs = raw.select(F.inline(F.array(
        F.struct(F.lit("genre").alias("kind"), F.col("genre").alias("value")),
        F.struct(F.lit("city").alias("kind"), F.col("venue_city").alias("value")))))
    return (pairs.filter(F.col("value").isNotNull()).distinct()
            .orderBy("kind", "value"))


# ------------------------------------------------------------------ price curve

def curve_report(raw: DataFrame, genre: str | None = None, city: str | None = None) -> DataFrame:
    """Observations, mean and median mid price per days-until-event bucket;
    prices are counted first, as in ``marts.price_curves``."""
    base = filtered(raw.filter(F.col("event_date").isNotNull() & F.col("min_price").isNotNull()),
                     genre, city)
    days = days_between("snapshot_date", "event_date")
    b = base.select(days_bucket(days, REPORT_LAST_LABEL).alias("days_bucket"),
                    bucket_order(days).alias("bucket_order"),
                    mid_price().alias("avg_price"))
    return curve_of_prices(b.groupBy(*b.columns).agg(F.count(F.lit(1)).alias("n")))


def curve_of_prices(prices: DataFrame) -> DataFrame:
    """The report of counted prices: days_bucket, bucket_order, avg_price, n."""
    return (prices.groupBy("days_bucket", "bucket_order")
            .agg(F.sum("n").alias("num_observations"),
                 rounded_avg("avg_price", 2, "n").alias("mean_price"),
                 round_half_away(exact_median("avg_price", "n"), 2).alias("median_price"))
            .orderBy("bucket_order"))


def curve_summary(report: DataFrame) -> DataFrame:
    """Cheapest bucket (first in bucket order among equal means), its mean,
    and the total observation count; no row for an empty report."""
    has_mean = F.col("mean_price").isNotNull()
    return (report.agg(
        _ordered_first(F.col("days_bucket"), "mean_price", "bucket_order", where=has_mean)
        .alias("best_bucket"),
        F.min("mean_price").alias("best_mean_price"),
        F.sum("num_observations").alias("total_observations"))
        .filter(F.col("total_observations").isNotNull()))


# ------------------------------------------------------------------ sell-outs

def sellout_report(raw: DataFrame, genre: str | None = None, city: str | None = None,
                   limit: int | None = 50) -> DataFrame:
    """Fastest sell-outs: days from first sighting to the first 'offsale'
    day per event (and name/artist/genre/city), sold-out events only,
    ascending, top ``limit`` (ties broken by event_id and the text columns).
    Plan: partial aggregation, one exchange, TakeOrderedAndProject."""
    base = filtered(raw, genre, city)
    off = F.col("status") == F.lit("offsale")
    g = (base.groupBy("event_id", F.col("name").alias("event_name"), "artist_name", "genre",
                      "venue_city")
         .agg(F.min("snapshot_date").alias("first_seen_date"),
              F.min(F.when(off, F.col("snapshot_date"))).alias("soldout_date")))
    days = F.datediff("soldout_date", "first_seen_date").cast("long")
    sold = (g.filter(F.col("soldout_date").isNotNull())
            .select("event_id", "artist_name", "event_name", "venue_city", "genre",
                    days.alias("days_to_sellout")))
    if limit is None:
        return sold.drop("event_id")
    return (sold.orderBy(*[F.asc_nulls_last(c) for c in
                       ("days_to_sellout", "event_id", "event_name", "artist_name", "genre",
                        "venue_city")])
            .limit(limit)
            .drop("event_id"))


def sellout_table(raw: DataFrame, genre: str | None = None, city: str | None = None,
                  rows: int = 15) -> DataFrame:
    """The first ``rows`` of the sell-out report (same order), table columns."""
    return (sellout_report(raw, genre, city, limit=rows)
            .select("artist_name", "event_name", "venue_city", "days_to_sellout"))


def sellout_summary(report: DataFrame) -> DataFrame:
    """Median (interpolated, DOUBLE) and minimum days-to-sellout over all
    sell-outs of ``report``; no row for an empty one.  Days are counted first:
    the last step sees each number of days once."""
    days = report.groupBy("days_to_sellout").agg(F.count(F.lit(1)).alias("n"))
    return (days.agg(F.percentile("days_to_sellout", F.lit(0.5), F.col("n")).alias("median_days"),
                     F.min("days_to_sellout").alias("fastest_days"))
            .filter(F.col("fastest_days").isNotNull()))


def sellout_histogram(report: DataFrame, max_bins: int = 15) -> DataFrame:
    """Equal-width integer bins over all days-to-sellout of ``report``: width is
    the smallest integer giving at most ``max_bins`` bins over [lo, hi].  The
    sell-outs are counted per number of days; both ends come back as a scalar
    subquery, so no task sees all rows."""
    days = report.groupBy("days_to_sellout").agg(F.count(F.lit(1)).alias("n"))
    x = F.col("days_to_sellout")
    ends = days.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    width = F.ceil((F.col("hi") - F.col("lo") + F.lit(1)) / F.lit(max_bins)).cast("long")
    shape = ends.select(F.struct("lo", width.alias("w")).alias("shape")).scalar()
    b = days.select(x, "n", shape.alias("shape"))
    lo, w = F.col("shape.lo"), F.col("shape.w")
    start = lo + F.floor((x - lo) / w).cast("long") * w
    return (b.select(start.alias("bin_start"), (start + w - 1).alias("bin_end"), "n")
            .groupBy("bin_start", "bin_end").agg(F.sum("n").alias("num_events"))
            .orderBy("bin_start"))


# ------------------------------------------------------------------ weekdays

def weekday_report(raw: DataFrame, genre: str | None = None, city: str | None = None,
                   min_observations: int = 5) -> DataFrame:
    """Mean mid and minimum price by weekday of the snapshot (Sunday = 0);
    weekdays with fewer than ``min_observations`` rows are dropped."""
    base = filtered(raw.filter(F.col("min_price").isNotNull()), genre, city)
    d = base.select(weekday_name("snapshot_date").alias("day_name"),
                    weekday_number("snapshot_date").alias("day_of_week"),
                    mid_price().alias("avg_price"), "min_price")
    return (d.groupBy("day_name", "day_of_week")
            .agg(F.count(F.lit(1)).alias("num_observations"),
                 rounded_avg("avg_price", 2).alias("mean_price"),
                 rounded_avg("min_price", 2).alias("mean_min_price"))
            .filter(F.col("num_observations") >= min_observations)
            .orderBy("day_of_week"))


def weekday_summary(report: DataFrame) -> DataFrame:
    """Cheapest and dearest weekday (first in weekday order on ties), their
    means and the difference; no row for an empty report."""
    has_mean = F.col("mean_price").isNotNull()
    return (report.agg(
        _ordered_first(F.col("day_name"), "mean_price", "day_of_week", where=has_mean)
        .alias("best_day"),
        F.min("mean_price").alias("best_mean_price"),
        _ordered_first(F.col("day_name"), F.negative("mean_price"), "day_of_week", where=has_mean)
        .alias("worst_day"),
        F.max("mean_price").alias("worst_mean_price"),
        (F.max("mean_price") - F.min("mean_price")).alias("savings"))
        .filter(F.col("best_day").isNotNull()))


# ------------------------------------------------------------------ explorer

EXPLORER_COLUMNS = ["artist_name", "event_name", "venue_name", "venue_city", "event_date",
                    "min_price", "max_price", "status", "genre"]


def _explorer_latest(raw: DataFrame, as_of: _dt.datetime, genre, city, search) -> DataFrame:
    base = filtered(raw.filter(F.col("event_date") > ntz_literal(as_of)),
                     genre, city)
    if search:
        pat = contains_pattern(search)
        base = base.filter(F.col("artist_name").ilike(pat) | F.col("name").ilike(pat))
    row = F.struct(*[F.col("name").alias("event_name") if c == "event_name" else F.col(c)
                     for c in EXPLORER_COLUMNS])
    # Newest snapshot per event: an aggregate (partial max_by map-side, one
    # row per event per task crosses the shuffle) rather than a sort.
    return (base.groupBy("event_id")
            .agg(F.max_by(row, F.col("snapshot_date")).alias("r"))
            .select("event_id", "r.*"))


def event_explorer(raw: DataFrame, as_of: _dt.datetime, genre: str | None = None,
                   city: str | None = None, search: str | None = None) -> DataFrame:
    """Newest snapshot of every event dated after ``as_of`` among the rows
    passing the filters; ``search`` is a case-insensitive contains on the
    artist or the event name."""
    return _explorer_latest(raw, as_of, genre, city, search).drop("event_id")


def explorer_page(raw: DataFrame, as_of: _dt.datetime, genre: str | None = None,
                  city: str | None = None, search: str | None = None,
                  rows: int = 100) -> DataFrame:
    """The first ``rows`` explorer rows by event date (then event id)."""
    return (_explorer_latest(raw, as_of, genre, city, search)
            .orderBy(F.asc_nulls_last("event_date"), F.asc("event_id"))
            .limit(rows).drop("event_id"))


def explorer_summary(explorer: DataFrame) -> DataFrame:
    """Count, count on sale, mean minimum and mean maximum price of all
    explorer rows (NULLs skipped); no row without any."""
    return (explorer.agg(F.count(F.lit(1)).alias("upcoming_events"),
                     F.count_if(F.col("status") == F.lit("onsale")).alias("on_sale"),
                     exact_avg("min_price").alias("avg_min_price"),
                     exact_avg("max_price").alias("avg_max_price"))
            .filter(F.col("upcoming_events") > 0))


# ------------------------------------------------------------------ anomalies

def anomaly_report(raw: DataFrame, genre: str | None = None, city: str | None = None,
                   threshold: float = 2.0, limit: int | None = 50,
                   min_snapshots: int = 3) -> DataFrame:
    """Snapshots whose mid price is at least ``threshold`` sample standard
    deviations from their event's mean over all priced days (events with at
    least ``min_snapshots`` priced rows and a non-zero deviation), largest
    |z| first, top ``limit``.

    The event statistics come from a window over event_id rather than a
    grouped join: one exchange of the priced rows, and a window partition
    holds one event's days (bounded by the number of snapshot days).  The
    genre/city filters apply to the scored rows only, after the window, so the
    statistics still cover the whole event."""
    priced = raw.filter(F.col("min_price").isNotNull())
    w = Window.partitionBy("event_id")
    mid = mid_price()
    s = priced.select(
        "event_id", F.col("name").alias("event_name"), "artist_name", "genre", "venue_city",
        "min_price", "max_price", mid.alias("avg_price"), "snapshot_date", "event_date",
        exact_avg(mid, window=w).alias("mean_price"),
        F.stddev_samp(mid).over(w).alias("stddev_price"),
        F.count(F.lit(1)).over(w).alias("_n"))
    s = filtered(s.filter((F.col("_n") >= min_snapshots) & (F.col("stddev_price") > 0)),
                  genre, city).drop("_n")
    z = z_score("avg_price", "mean_price", "stddev_price")
    far = (s.withColumn("z_score", z)
           .filter(F.abs(F.col("z_score")) >= F.lit(threshold))
           .withColumn("anomaly_type", anomaly_type("z_score", threshold)))
    if limit is None:
        return far
    return (far.orderBy(F.abs(F.col("z_score")).desc(), F.asc("event_id"), F.asc("snapshot_date"))
            .limit(limit))


def anomaly_chart(report: DataFrame) -> DataFrame:
    """Chart rows of the anomaly report: kind, the short series label
    (artist + ' — ' + the first 20 characters of the event name; NULL when
    either is missing) and z, in report order (``position``)."""
    label = F.concat(F.col("artist_name"), F.lit(" — "), F.substring("event_name", 1, 20))
    w = Window.orderBy(F.abs(F.col("z_score")).desc(), F.asc("event_id"), F.asc("snapshot_date"))
    # the report is a top-k (at most ``limit`` rows), so one ordered window is bounded
    return report.select(F.row_number().over(w).cast("long").alias("position"),
                         "anomaly_type", label.alias("label"), "z_score")


def anomaly_summary(report: DataFrame) -> DataFrame:
    """Counts by kind over all anomalies and the first drop in report order
    (largest |z|): its artist, mid price, event mean and z; no row without
    anomalies."""
    is_drop = F.col("anomaly_type") == F.lit(DROP)
    first_drop = _ordered_first(
        F.struct("artist_name", "avg_price", "mean_price", "z_score"),
        F.negative(F.abs("z_score")), "event_id", "snapshot_date", where=is_drop)
    return (report.agg(F.count(F.lit(1)).alias("total_anomalies"),
                       F.count_if(is_drop).alias("price_drops"),
                       F.count_if(F.col("anomaly_type") == F.lit(SPIKE)).alias("price_spikes"),
                       first_drop.alias("d"))
            .filter(F.col("total_anomalies") > 0)
            .select("total_anomalies", "price_drops", "price_spikes",
                    F.col("d.artist_name").alias("best_deal_artist"),
                    F.col("d.avg_price").alias("best_deal_price"),
                    F.col("d.mean_price").alias("best_deal_mean_price"),
                    F.col("d.z_score").alias("best_deal_z_score")))


# Display headers of the report tables (column -> header).
DISPLAY_HEADERS = {
    "sellout": {"artist_name": "Artist", "event_name": "Event", "venue_city": "City",
                "days_to_sellout": "Days to Sell Out"},
    "explorer": {"artist_name": "Artist", "event_name": "Event", "venue_name": "Venue",
                 "venue_city": "City", "event_date": "Date", "min_price": "Min $",
                 "max_price": "Max $", "status": "Status", "genre": "Genre"},
    "anomalies": {"artist_name": "Artist", "event_name": "Event", "venue_city": "City",
                  "avg_price": "Current $", "mean_price": "Avg $", "z_score": "Z-Score",
                  "anomaly_type": "Type", "snapshot_date": "Date"},
}


def with_display_headers(report: DataFrame, table: str) -> DataFrame:
    """The table's columns under their display headers (the anomaly table
    shows only its eight listed columns)."""
    headers = DISPLAY_HEADERS[table]
    if table == "anomalies":
        report = report.select(*headers)
    return report.withColumnsRenamed(headers)
