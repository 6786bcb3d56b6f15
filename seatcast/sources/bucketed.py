"""The snapshots as a catalog table bucketed by event.

Plans that meet by event -- the price history's window, the statistics of an event and
the join of the two -- shuffle the whole store on ``event_id`` each time.  In this table
every file holds one bucket of events, so they run on what a task reads, without an
exchange; within a bucket they sort or hash as usual.

The table is also partitioned by ``snapshot_date``: replacing a day rewrites that day's
files alone.  A day has one file per bucket, so the number of buckets trades files
against the size of a bucket's task, which reads its share of all days: choose them so
that a bucket of the whole history is a few hundred megabytes.  A bucket holds many
events, and an event one row a day, so no event makes a bucket heavy.

The bucketing is known to the catalog: read the table by name.  Several writers of one
table must not run at once, as for the store.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SNAPSHOT

DAY = "snapshot_date"
_MODE = "spark.sql.sources.partitionOverwriteMode"


def create(spark: SparkSession, table: str, path: str, buckets: int) -> None:
    """An empty table ``table`` with its files below ``path``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SNAPSHOT.fields)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({DAY}) "
              f"CLUSTERED BY (event_id) SORTED BY (event_id) INTO {int(buckets)} BUCKETS "
              f"LOCATION '{location}'")


def buckets_of(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'")
    return int(rows.first()["data_type"])


def replace_days(rows: DataFrame, table: str, days: list[_dt.date]) -> None:
    """``days`` of the table become what ``rows`` (schema ``SNAPSHOT``) has for them: a
    day without rows goes.  ``store.upsert_days`` returns the days it replaced."""
    if not days:
        return
    spark = rows.sparkSession
    own = rows.where(F.col(DAY).isin(days))
    names = [c for c in SNAPSHOT.fieldNames() if c != DAY] + [DAY]
    # dealt as the buckets are: a task writes one bucket, one file of it a day
    dealt = own.select(*names).repartition(buckets_of(spark, table), "event_id")
    before = spark.conf.get(_MODE, None)
    spark.conf.set(_MODE, "dynamic")
    try:
        dealt.write.insertInto(table, overwrite=True)
    finally:
        if before is None:
            spark.conf.unset(_MODE)
        else:
            spark.conf.set(_MODE, before)
    stored = {r[0] for r in own.select(DAY).distinct().collect()}
    for d in sorted(set(days) - stored):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({DAY} = DATE'{d.isoformat()}')")


def read(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select(*SNAPSHOT.fieldNames())
