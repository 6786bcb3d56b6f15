"""The snapshot store: Parquet partitioned by ``snapshot_date``.

* ``duplicate_keys``  (event_id, snapshot_date) pairs occurring more than once
* ``upsert_days``     replace whole days: every day present in the batch (and
                      every day named in ``days``, even with no rows) ends up
                      holding exactly the batch's rows for it; other days are
                      untouched
* ``read_store``      the stored rows; filters on snapshot_date prune
                      directories

Replacing uses dynamic partition overwrite (only the partitions written are
replaced, atomically per task commit).  A day named in ``days`` with no rows
in the batch writes no file, so its old directory is removed explicitly after
the write -- the original DELETE-then-INSERT empties such a day too.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import ntz_literal
from ..schemas import SNAPSHOT, SNAPSHOT_KEY
from .pages import DATE_REJECTED


class DuplicateKeyError(ValueError):
    pass


def duplicate_keys(rows: DataFrame, include_missing: bool = False,
                   key: list[str] | None = None) -> DataFrame:
    """Keys (``SNAPSHOT_KEY`` by default) that occur more than once, with their
    count (partial aggregation: a hot key is counted map-side before the
    shuffle).  ``include_missing`` also reports keys with a NULL part (an event
    without an id cannot be stored)."""
    key = list(key or SNAPSHOT_KEY)
    bad = F.col("n") > 1
    if include_missing:
        for c in key:
            bad = bad | F.col(c).isNull()
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(bad)


def one_per_key(rows: DataFrame, key: list[str] | None = None) -> DataFrame:
    """One row per key, by a fixed order over all columns, so that reruns agree."""
    key = list(key or SNAPSHOT_KEY)
    rest = [F.col(c).asc_nulls_last() for c in rows.columns if c not in key]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*rest))
    return rows.select("*", rank.alias("_rank")).filter("_rank = 1").drop("_rank")


def conform(rows: DataFrame, ingested_at: _dt.datetime | None = None,
            keep: list[str] | None = None) -> DataFrame:
    """Cast/order to ``SNAPSHOT`` (and the columns to ``keep``); ``ingested_at``
    defaults to the given stamp or, without one, to the session's local time."""
    stamp = (ntz_literal(ingested_at) if ingested_at is not None
             else F.localtimestamp())
    cols = []
    for f in SNAPSHOT.fields:
        if f.name == "ingested_at" and "ingested_at" not in rows.columns:
            cols.append(stamp.alias("ingested_at"))
        elif f.name == "ingested_at":
            cols.append(F.coalesce(F.col("ingested_at").cast("timestamp_ntz"), stamp)
                        .alias("ingested_at"))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return rows.select(*cols, *(keep or []))


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def upsert_days(rows: DataFrame, store: str, *, days: list[_dt.date] | None = None,
                dedupe: bool = False, ingested_at: _dt.datetime | None = None) -> dict:
    """Replace the batch's days in the store (see module doc).

    Duplicate or missing keys raise ``DuplicateKeyError`` before anything is
    written (``dedupe=True`` keeps one row per key, see ``one_per_key``, instead
    of raising on duplicates).  The check reads the key columns only; nothing
    holds the batch between check and write.  Returns counters: rows written,
    days replaced, days emptied, date texts rejected if the rows say so, and the
    days themselves (``replaced``) for what is kept between days (``state``)."""
    spark = rows.sparkSession
    rejected = F.count_if(F.col(DATE_REJECTED)) if DATE_REJECTED in rows.columns else F.lit(0)
    own = conform(rows, ingested_at)
    if DATE_REJECTED in rows.columns:
        own = conform(rows, ingested_at, keep=[DATE_REJECTED])
    if dedupe:
        own = one_per_key(own)
    if not duplicate_keys(own, include_missing=True).isEmpty():
        raise DuplicateKeyError(
            f"missing or duplicate (event_id, snapshot_date) in batch for {store}")
    metrics: dict = {}
    if not own.isEmpty():
        metrics = _write(own, store, rejected)
    written = set(metrics.get("days") or [])
    emptied = []
    for d in days or []:
        if d not in written:
            fs, p = _fs(spark, f"{store.rstrip('/')}/snapshot_date={d.isoformat()}")
            if fs.exists(p):
                fs.delete(p, True)
                emptied.append(d)
    return {"rows": metrics.get("rows", 0), "days": len(written), "emptied_days": len(emptied),
            "rejected_dates": metrics.get("rejected", 0) or 0,
            "replaced": sorted(written.union(emptied))}


def _write(own: DataFrame, store: str, rejected) -> dict:
    """Replace the batch's days; rows, rejected dates and days from the write's
    own metrics."""
    obs = Observation("ingest")
    # the written days come back with the write's own metrics (a handful of
    # dates per batch), no second pass over the rows
    seen = own.observe(obs, F.count(F.lit(1)).alias("rows"), rejected.alias("rejected"),
                       F.collect_set("snapshot_date").alias("days")).select(SNAPSHOT.fieldNames())
    # rebalance: a day's rows meet in one task, so it gets few files; adaptive
    # execution splits a day that is large.  dynamic: only the partitions this
    # batch writes are replaced (a write option, so concurrent jobs in the
    # session are unaffected)
    (seen.hint("rebalance", "snapshot_date").write.mode("overwrite")
     .partitionBy("snapshot_date").option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd").parquet(store))
    return obs.get


def newest_day(spark: SparkSession, store: str) -> _dt.date | None:
    """The newest stored day, from the folder names alone."""
    fs, p = _fs(spark, store)
    if not fs.exists(p):
        return None
    found = [s.getPath().getName() for s in fs.listStatus(p)]
    return max((_dt.date.fromisoformat(n.partition("=")[2]) for n in found
                if n.startswith("snapshot_date=")), default=None)


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """Stored snapshots (schema ``SNAPSHOT``; snapshot_date from the path)."""
    return spark.read.schema(SNAPSHOT).parquet(store).select(*SNAPSHOT.fieldNames())
