"""The totals behind the price statistics, and the statistics read from them.

* ``MOMENTS``      per event and its descriptive columns: rows, prices, their sum and
                   the sum of their squares, in millionths
* ``PRICE_COUNTS`` per genre, city, days-until-event bucket and price: how many rows
* ``WEEKDAYS``     per genre, city and weekday: rows, sums of mid and minimum prices

The functions that read them give what ``operators`` compute from all rows:
``event_stats``, ``alert_stats``, ``price_curves``, ``curve_report``,
``best_buy_windows``.  Prices must be finite and below 10^9.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (MART_LAST_LABEL, REPORT_LAST_LABEL, bucket_label, bucket_order, dec2,
                         mean_of_sums, mid_price, micros_parts, price_micros, weekday_number,
                         days_between)
from ..operators import marts, reports
from .totals import Total

_WIDE = "decimal(38,0)"


def _moments(rows: DataFrame) -> DataFrame:
    """Rows with a minimum price; those without a maximum count, but have no price."""
    mid = mid_price()
    whole, frac = micros_parts(mid)
    micros = price_micros(mid).cast("decimal(19,0)")
    return (rows.where(F.col("min_price").isNotNull())
            .groupBy("snapshot_date", "event_id", F.col("name").alias("event_name"),
                     "artist_name", "genre", "venue_city",
                     F.col("event_date").isNotNull().alias("dated"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count(mid).alias("n"),
                 F.coalesce(F.sum(whole), F.lit(0)).alias("whole"),
                 F.coalesce(F.sum(frac), F.lit(0)).alias("frac"),
                 F.coalesce(F.sum(micros * micros), F.lit(0)).cast(_WIDE).alias("squares")))


def _price_counts(rows: DataFrame) -> DataFrame:
    days = days_between("snapshot_date", "event_date")
    return (rows.where(F.col("event_date").isNotNull() & F.col("min_price").isNotNull())
            .groupBy("snapshot_date", "genre", "venue_city",
                     bucket_order(days).alias("bucket_order"), "min_price", "max_price")
            .agg(F.count(F.lit(1)).alias("n")))


def _weekdays(rows: DataFrame) -> DataFrame:
    mid = mid_price()
    whole, frac = micros_parts(mid)
    low_whole, low_frac = micros_parts("min_price")
    return (rows.where(F.col("event_date").isNotNull() & mid.isNotNull())
            .groupBy("snapshot_date", "genre", "venue_city",
                     weekday_number("snapshot_date").alias("day_of_week"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(whole).alias("whole"),
                 F.sum(frac).alias("frac"), F.sum(low_whole).alias("low_whole"),
                 F.sum(low_frac).alias("low_frac")))


MOMENTS = Total("moments", ("event_id", "event_name", "artist_name", "genre", "venue_city",
                            "dated"), ("n_rows", "n", "whole", "frac", "squares"), _moments)
PRICE_COUNTS = Total("price_counts", ("genre", "venue_city", "bucket_order", "min_price",
                                      "max_price"), ("n",), _price_counts)
WEEKDAYS = Total("weekdays", ("genre", "venue_city", "day_of_week"),
                 ("n", "whole", "frac", "low_whole", "low_frac"), _weekdays)
TOTALS = (MOMENTS, PRICE_COUNTS, WEEKDAYS)


# ------------------------------------------------------------ statistics

def stddev_of_sums(n: Column, whole: Column, frac: Column, squares: Column) -> Column:
    """Sample standard deviation from count, sum and sum of squares in millionths:
    n * squares - sum^2 is a whole number, so equal prices give exactly 0.  NULL below
    two prices."""
    total = whole.cast(_WIDE) * F.lit(1000000) + frac.cast(_WIDE)
    exact = F.try_subtract(F.try_multiply(squares.cast(_WIDE), n.cast("decimal(19,0)")),
                           F.try_multiply(total.cast(_WIDE), total.cast(_WIDE)))
    rough = squares.cast("double") * n - total.cast("double") * total.cast("double")
    scatter = F.greatest(F.coalesce(exact.cast("double"), rough), F.lit(0.0))
    count = n.cast("double")
    return F.when(n > 1, F.sqrt(scatter / (count * (count - F.lit(1)))) / F.lit(1e6))


def _summed(moments: DataFrame, *keys: str) -> DataFrame:
    return moments.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in MOMENTS.sums])


def _mean_and_deviation() -> list[Column]:
    c = [F.col(x) for x in ("n", "whole", "frac", "squares")]
    return [mean_of_sums(c[1], c[2], c[0]).alias("mean_price"),
            stddev_of_sums(*c).alias("stddev_price")]


def event_stats(moments: DataFrame, *, min_snapshots: int = 3) -> DataFrame:
    """``marts.event_stats``: dated rows with a mid price."""
    per_event = _summed(moments.where("dated AND n > 0"), *marts.STATS_KEYS)
    return (per_event.where(F.col("n") >= min_snapshots)
            .select(*marts.STATS_KEYS, *_mean_and_deviation(),
                    F.col("n").alias("num_snapshots")))


def alert_stats(moments: DataFrame, *, min_snapshots: int = 3) -> DataFrame:
    """``alerts.price_stats``: event_id, mean_price, stddev_price."""
    return (_summed(moments, "event_id").where(F.col("n_rows") >= min_snapshots)
            .select("event_id", *_mean_and_deviation()).where("stddev_price > 0"))


# ------------------------------------------------------------ curves

def price_curves(counts: DataFrame, *, last_label: str = MART_LAST_LABEL) -> DataFrame:
    """``marts.price_curves``: the median comes from the counted prices."""
    avg = mid_price()
    prices = counts.where(avg.isNotNull()).select(
        "genre", "venue_city", bucket_label("bucket_order", last_label).alias("days_bucket"),
        "bucket_order", avg.alias("avg_price"), "n", F.col("min_price").alias("lo"),
        F.col("max_price").alias("hi"))
    return marts.curves_of_prices(prices)


def curve_report(counts: DataFrame, genre: str | None = None,
                 city: str | None = None) -> DataFrame:
    """``reports.curve_report``, from the counted prices."""
    prices = reports.filtered(counts, genre, city).select(
        bucket_label("bucket_order", REPORT_LAST_LABEL).alias("days_bucket"), "bucket_order",
        mid_price().alias("avg_price"), "n")
    return reports.curve_of_prices(prices)


def best_buy_windows(weekdays: DataFrame, *, min_observations: int = 5) -> DataFrame:
    """``marts.best_buy_windows``, from the weekday sums."""
    return marts.ranked_weekdays(weekdays.select(
        "genre", "venue_city", "day_of_week", F.col("n").alias("num_observations"),
        dec2(mean_of_sums("whole", "frac", "n")).alias("mean_price"),
        dec2(mean_of_sums("low_whole", "low_frac", "n")).alias("mean_min_price")),
        min_observations)
