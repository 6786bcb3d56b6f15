"""Bridge from the driver's generic tables to ticket snapshots.

The test data has no ticket prices, so one snapshot row is derived per
(user_id, day) of ``events``:

* event_id = user_id as text, name = part name + ' #' + id
* event_date = 2024-01-31 19:30 + (id mod 45) days, NULL when id mod 41 = 0
* venue = 'Hall ' + (id mod 20); city = region name; state = nation name
  (through the customer with that key); capacity = part size * 100
* genre / subgenre / artist = part type / brand / name
* prices = min / max of the day's non-error event values; even ids keep the
  value, odd ids mirror it to round(1000 - value, 2) (so even ids get upward
  tails, odd ids downward ones)
* status = 'offsale' once the day has a purchase of 150 or more

Plan shape (scales with ``events``): the events are aggregated to
(user_id, day) first -- partial aggregation map-side, so a user holding a third
of all events is split across map tasks and days before any shuffle -- and
only the aggregated rows (at most one per user per day) are joined to the
dimensions.  ``part`` and ``customer`` are keyed by user_id (TPC-H primary
keys, unique), so grouping before joining gives the same rows as joining
first.  No broadcast hints: Catalyst/AQE broadcast a dimension only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ntz_literal, round_half_away
from .tables import table

# Fixed values of the bridge.
EVENT_DATE_BASE = _dt.datetime(2024, 1, 31, 19, 30, 0)
NO_DATE_MODULUS = 41
DATE_SPREAD_MODULUS = 45
VENUE_MODULUS = 20
SOLD_OUT_PURCHASE = 150.0


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot rows (schema ``SNAPSHOT``) derived from the driver tables."""
    ev = table(spark, sf_dir, "events", "user_id", "ts", "event_type", "value")
    uid = F.col("user_id")
    price = (F.when(uid % 2 == 0, F.col("value"))
             .otherwise(round_half_away(F.lit(1000) - F.col("value"), 2)))
    priced = F.col("event_type") != F.lit("error")
    sold_out = (F.col("event_type") == F.lit("purchase")) & (F.col("value") >= F.lit(SOLD_OUT_PURCHASE))

    daily = (ev.groupBy(uid, F.to_date("ts").alias("snapshot_date"))
             .agg(F.min(F.when(priced, price)).alias("min_price"),
                  F.max(F.when(priced, price)).alias("max_price"),
                  F.count_if(sold_out).alias("_big_buys")))

    part = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    customer = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region", "r_regionkey", "r_name")

    # Each dimension joins the aggregated rows directly, so each keeps its own
    # size estimate for the broadcast threshold (an estimate of a join of
    # dimensions is the product of their sizes and would never qualify).
    joined = (daily.join(part, uid == F.col("p_partkey"), "left")
              .join(customer, uid == F.col("c_custkey"), "left")
              .join(nation, F.col("n_nationkey") == F.col("c_nationkey"), "left")
              .join(region, F.col("r_regionkey") == F.col("n_regionkey"), "left"))

    id_text = uid.cast("string")
    event_date = F.when(uid % NO_DATE_MODULUS != 0,
                        F.timestamp_add("DAY", (uid % DATE_SPREAD_MODULUS).cast("int"),
                                       ntz_literal(EVENT_DATE_BASE)))
    return joined.select(
        id_text.alias("event_id"),
        F.concat(F.col("p_name"), F.lit(" #"), id_text).alias("name"),
        event_date.alias("event_date"),
        F.concat(F.lit("Hall "), (uid % VENUE_MODULUS).cast("string")).alias("venue_name"),
        F.col("r_name").alias("venue_city"),
        F.col("n_name").alias("venue_state"),
        (F.col("p_size") * 100).cast("int").alias("venue_capacity"),
        F.col("p_type").alias("genre"),
        F.col("p_brand").alias("subgenre"),
        F.col("p_name").alias("artist_name"),
        "min_price",
        "max_price",
        F.lit("USD").alias("currency"),
        F.when(F.col("_big_buys") > 0, F.lit("offsale")).otherwise(F.lit("onsale")).alias("status"),
        F.lit("").alias("url"),
        "snapshot_date",
        F.col("snapshot_date").cast("timestamp_ntz").alias("ingested_at"),
    )


def newest_day(spark: SparkSession, sf_dir: str) -> _dt.date | None:
    """The newest snapshot day: one narrow column of ``events``."""
    return table(spark, sf_dir, "events", "ts").agg(F.to_date(F.max("ts"))).first()[0]
