"""Marts: price curves, weekday buy windows, sell-out velocity, event price
statistics and z-score anomalies.  Inputs are ``price_snapshots`` rows.

Decimal outputs follow ``round(x::numeric, 2)`` (see ``functions.dec2``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (MART_LAST_LABEL, anomaly_type, bucket_order, days_bucket, dec2,
                         exact_avg, exact_median, weekday_name_of_number, weekday_number,
                         weighted_avg)

VELOCITY_KEYS = ["event_id", "event_name", "artist_name", "genre", "venue_name",
                 "venue_city", "event_date"]
CURVE_KEYS = ["genre", "venue_city", "days_bucket", "bucket_order"]
STATS_KEYS = ["event_id", "event_name", "artist_name", "genre", "venue_city"]


def _priced(snaps: DataFrame) -> DataFrame:
    return snaps.filter(F.col("avg_price").isNotNull())


def price_curves(snaps: DataFrame, *, last_label: str = MART_LAST_LABEL) -> DataFrame:
    """Prices by genre x city x days-until-event bucket.

    Two levels: the rows of a group are counted per distinct price first, which
    is combined map-side and spreads a large group over many tasks; the group
    then sees each price once, with its count.  Mean and median are exact
    before the rounding recipe.  Prices must be finite (an error otherwise) and
    are taken to millionths."""
    days = F.col("days_until_event")
    prices = (_priced(snaps).select(
        "genre", "venue_city", days_bucket(days, last_label).alias("days_bucket"),
        bucket_order(days).alias("bucket_order"), "avg_price", "min_price", "max_price")
        .groupBy(*CURVE_KEYS, "avg_price")
        .agg(F.count(F.lit(1)).alias("n"), F.min("min_price").alias("lo"),
             F.max("max_price").alias("hi")))
    return curves_of_prices(prices)


def curves_of_prices(prices: DataFrame) -> DataFrame:
    """The curves of counted prices: ``CURVE_KEYS``, avg_price, n, lo, hi."""
    return (prices.groupBy(*CURVE_KEYS)
            .agg(F.sum("n").alias("num_observations"),
                 dec2(weighted_avg("avg_price", "n")).alias("mean_price"),
                 dec2(exact_median("avg_price", "n")).alias("median_price"),
                 dec2(F.min("lo")).alias("lowest_price_seen"),
                 dec2(F.max("hi")).alias("highest_price_seen"))
            .orderBy(F.asc_nulls_last("genre"), F.asc_nulls_last("venue_city"),
                     F.asc_nulls_last("bucket_order")))


def best_buy_windows(snaps: DataFrame, *, min_observations: int = 5) -> DataFrame:
    """Mean prices by genre x city x weekday of the snapshot; groups with at
    least ``min_observations`` rows are ranked by mean price within genre x
    city (rank: ties share a rank, gaps follow).  The rank window sees at most
    seven rows per partition."""
    daily = _priced(snaps).select(
        "genre", "venue_city", weekday_number("snapshot_date").alias("day_of_week"),
        "avg_price", "min_price")
    by_day = (daily.groupBy("genre", "venue_city", "day_of_week")
              .agg(F.count(F.lit(1)).alias("num_observations"),
                   dec2(exact_avg("avg_price")).alias("mean_price"),
                   dec2(exact_avg("min_price")).alias("mean_min_price")))
    return ranked_weekdays(by_day, min_observations)


def ranked_weekdays(by_day: DataFrame, min_observations: int) -> DataFrame:
    """Weekday rows (num_observations, mean_price, mean_min_price) with enough
    observations, named and ranked."""
    w = Window.partitionBy("genre", "venue_city").orderBy(F.asc_nulls_last("mean_price"))
    return (by_day.filter(F.col("num_observations") >= min_observations)
            .select("genre", "venue_city", "day_of_week",
                    weekday_name_of_number("day_of_week").alias("day_name"),
                    "num_observations", "mean_price", "mean_min_price",
                    F.rank().over(w).cast("long").alias("price_rank")))


def soldout_velocity(snaps: DataFrame) -> DataFrame:
    """First day seen, first sold-out day, and the smallest days-until-event
    among sold-out rows, per event *and* event date (a rescheduled event gives
    two rows).  None of the history window's columns is needed, so Catalyst
    drops the window: the snapshots are aggregated straight from the scan,
    partially map-side, with one exchange of the combined rows."""
    off = F.col("status") == F.lit("offsale")
    return (snaps.groupBy(*VELOCITY_KEYS)
            .agg(F.min("snapshot_date").alias("first_seen_date"),
                 F.min(F.when(off, F.col("snapshot_date"))).alias("soldout_date"),
                 F.min(F.when(off, F.col("days_until_event"))).alias("days_before_event_soldout"))
            .select("*",
                    F.datediff("soldout_date", "first_seen_date").cast("long").alias("days_to_sellout"),
                    F.col("soldout_date").isNotNull().alias("did_sell_out")))


def event_stats(snaps: DataFrame, *, min_snapshots: int = 3) -> DataFrame:
    """Mean, sample standard deviation and count of an event's mid prices
    over its whole history, per event_id and its descriptive columns; events
    with fewer than ``min_snapshots`` priced rows are dropped."""
    return (_priced(snaps).groupBy(*STATS_KEYS)
            .agg(exact_avg("avg_price").alias("mean_price"),
                 F.stddev_samp("avg_price").alias("stddev_price"),
                 F.count(F.lit(1)).alias("num_snapshots"))
            .filter(F.col("num_snapshots") >= min_snapshots))


def price_anomalies(snaps: DataFrame, *, min_snapshots: int = 3,
                    threshold: float = 2.0) -> DataFrame:
    """Every priced snapshot with its event's z-score (2 dp, 0 when the
    deviation is 0/NULL) and spike/drop/normal label.

    Joined on event_id only while the statistics are grouped by event_id and
    four descriptive columns: an event seen under two names with enough rows
    under each gets one output row per name group (kept on purpose).  The
    statistics side aggregates straight from the scan (the window is pruned
    there) to one row per event and name; AQE broadcasts it when it is
    measured small, otherwise it is a sort-merge join on event_id whose history
    side keeps the window's event_id partitioning."""
    return anomalies_against(snaps, event_stats(snaps, min_snapshots=min_snapshots), threshold)


def anomalies_against(snaps: DataFrame, stats: DataFrame, threshold: float = 2.0) -> DataFrame:
    """``price_anomalies`` for given event statistics."""
    stats = stats.select("event_id", "mean_price", "stddev_price")
    s = _priced(snaps).select(
        "event_id", "event_name", "artist_name", "genre", "venue_city", "snapshot_date",
        "avg_price", "min_price", "max_price", "price_change", "price_change_pct",
        "days_until_event")
    sd = F.col("stddev_price")
    z = (F.when(sd > 0, dec2((F.col("avg_price") - F.col("mean_price")) / sd))
         .otherwise(F.lit(0).cast("decimal(18,2)")))
    scored = s.join(stats, "event_id").select("*", z.alias("z_score"))
    return scored.select(
        "*",
        anomaly_type("z_score", threshold).alias("anomaly_type"),
        (F.abs(F.col("z_score")) >= F.lit(threshold)).alias("is_anomaly"))
