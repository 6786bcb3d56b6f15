"""Staging: the cleaned snapshot view and the per-event price history.

Both are lazy; ``plans.build.build_marts(stage_history=True)`` writes the
history once when the marts should share it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import days_between, dec2, mid_price


def stg_events(raw: DataFrame) -> DataFrame:
    """Raw snapshots with ``event_name``, mid ``avg_price`` and
    ``days_until_event``; rows without an event date are dropped."""
    return (raw.filter(F.col("event_date").isNotNull())
            .select(
                "event_id",
                F.col("name").alias("event_name"),
                F.col("event_date").cast("timestamp_ntz").alias("event_date"),
                "venue_name", "venue_city", "venue_state", "venue_capacity",
                "genre", "subgenre", "artist_name", "min_price", "max_price",
                mid_price().alias("avg_price"),
                "currency", "status", "url", "snapshot_date", "ingested_at",
                days_between("snapshot_date", "event_date").alias("days_until_event"),
            ))


def price_snapshots(stg: DataFrame) -> DataFrame:
    """Per-event history: previous row's mid price (the previous *row*, even
    when days are missing or its price is NULL), 1-based snapshot number,
    absolute change and percent change (only when the previous price > 0,
    DECIMAL(18,2)).

    One shuffle: hash partitioning on event_id.  A window partition holds one
    event's days, bounded by the number of snapshot days (the key is unique).
    Consumers that use none of the window's columns (curves, weekdays,
    velocity, statistics) get the window pruned away by Catalyst."""
    w = Window.partitionBy("event_id").orderBy("snapshot_date")
    return _with_changes(stg.select(
        *HISTORY_INPUT,
        F.lag("avg_price").over(w).alias("prev_avg_price"),
        F.row_number().over(w).cast("long").alias("snapshot_number"),
    ))


HISTORY_INPUT = ["event_id", "event_name", "artist_name", "genre", "venue_name", "venue_city",
                 "event_date", "snapshot_date", "min_price", "max_price", "avg_price", "status",
                 "days_until_event"]
LAST_ROW = ["event_id", "snapshot_date", "avg_price", "snapshot_number"]


def continued_snapshots(stg: DataFrame, last: DataFrame) -> DataFrame:
    """``price_snapshots`` of rows that follow ``last``, the last known row of each
    event (``LAST_ROW``): that row goes first in the event's window, so the
    earlier history is not needed."""
    w = Window.partitionBy("event_id").orderBy("snapshot_date")
    known = last.select("event_id", "snapshot_date", "avg_price",
                        F.col("snapshot_number").alias("_known"))
    rows = stg.select(*HISTORY_INPUT, F.lit(None).cast("long").alias("_known")).unionByName(
        known, allowMissingColumns=True)
    # row 1 is the known one, if there is one: it carries the number to go on from
    before = F.coalesce(F.first("_known").over(w) - 1, F.lit(0))
    numbered = rows.select(
        *HISTORY_INPUT, "_known",
        F.lag("avg_price").over(w).alias("prev_avg_price"),
        (F.row_number().over(w) + before).cast("long").alias("snapshot_number"))
    return _with_changes(numbered.filter(F.col("_known").isNull()).drop("_known"))


def _with_changes(hist: DataFrame) -> DataFrame:
    cur, prev = F.col("avg_price"), F.col("prev_avg_price")
    return hist.select(
        "*",
        (cur - prev).alias("price_change"),
        F.when(prev > 0, dec2((cur - prev) / prev * F.lit(100))).alias("price_change_pct"),
    )
