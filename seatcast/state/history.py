"""The price history by day, continued from the last known row of each event.

A folder holds

    rows/snapshot_date=D/   the ``price_snapshots`` rows of day D
    last/as_of=D/           the last row of each event up to the end of day D

Appending a day reads that day's stored rows and the newest ``last`` table.  When an
older day is replaced, every later row of its events may change (numbers shift,
the next row sees another price), so the work goes back to the newest ``last`` table
before that day and continues from there.  Such tables are kept for the newest day
and for every ``EVERY``-th day, so a rewind reads at most that many days more than it
has to write.

Order of the writes: ``last`` tables from the replaced day on go first, then the rows
are replaced, then new ``last`` tables are written.  After a crash in between, the same
update starts from an older table and gives the same rows.  Until it has been run,
``is_current`` says that the newest stored day is not covered.  (A store without any
dated row has no ``last`` table; its history is empty.)
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.staging import LAST_ROW, continued_snapshots, price_snapshots, stg_events
from ..schemas import SNAPSHOT
from ..sources import store
from . import files

# Distance of the ``last`` tables that stay, in days.
EVERY = 16


def _days(spark: SparkSession, path: str, key: str) -> list[_dt.date]:
    return sorted(_dt.date.fromisoformat(n.partition("=")[2]) for n in files.names(spark, path)
                  if n.startswith(f"{key}="))


def _folder(path: str, key: str, day: _dt.date) -> str:
    return f"{path}/{key}={day.isoformat()}"


def read(spark: SparkSession, path: str) -> DataFrame:
    """The history, as ``price_snapshots`` gives it."""
    schema = price_snapshots(stg_events(spark.createDataFrame([], SNAPSHOT))).schema
    return spark.read.schema(schema).parquet(f"{path}/rows").select(*schema.names)


def is_current(spark: SparkSession, store_path: str, path: str) -> bool:
    """Does the history reach up to the newest stored day?"""
    return store.newest_day(spark, store_path) in _days(spark, f"{path}/last", "as_of")


def start(spark: SparkSession, path: str, first: _dt.date) -> _dt.date | None:
    """The day of the newest ``last`` table before ``first``."""
    return max((d for d in _days(spark, f"{path}/last", "as_of") if d < first), default=None)


def new_rows(spark: SparkSession, store_path: str, path: str, first: _dt.date,
             base: _dt.date | None) -> DataFrame:
    """The history from ``first`` on, continued from the ``last`` table of ``base``;
    without one, from the first stored day."""
    raw = store.read_store(spark, store_path)
    if base is None:
        made = price_snapshots(stg_events(raw))
    else:
        raw = raw.where(F.col("snapshot_date") > F.lit(base))
        made = continued_snapshots(stg_events(raw), _last(spark, path, base))
    return made.where(F.col("snapshot_date") >= F.lit(first))


def _last(spark: SparkSession, path: str, day: _dt.date) -> DataFrame:
    return spark.read.parquet(_folder(f"{path}/last", "as_of", day)).select(*LAST_ROW)


def update(spark: SparkSession, store_path: str, path: str, days: list[_dt.date],
           every: int = EVERY) -> None:
    """Bring the history up to date after ``days`` were replaced in the store (an
    emptied day counts as replaced)."""
    first = min(days)
    base = start(spark, path, first)
    for day in _days(spark, f"{path}/last", "as_of"):
        if day >= first:
            files.remove(spark, _folder(f"{path}/last", "as_of", day))
    rows = new_rows(spark, store_path, path, first, base)
    (rows.hint("rebalance", "snapshot_date").write.mode("overwrite")
     .partitionBy("snapshot_date").option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd").parquet(f"{path}/rows"))
    stored = set(_days(spark, store_path, "snapshot_date"))
    for day in _days(spark, f"{path}/rows", "snapshot_date"):
        if day >= first and day not in stored:
            files.remove(spark, _folder(f"{path}/rows", "snapshot_date", day))
    if stored:
        _keep_last(spark, path, base, sorted(stored), every)


def _keep_last(spark: SparkSession, path: str, base: _dt.date | None, stored: list[_dt.date],
               every: int) -> None:
    """Write the ``last`` tables of the newest day and of every ``every``-th day after
    ``base``, in one pass: a row is an event's last one from its day up to the next
    row's.  Newest tables that are neither any more go."""
    newest = stored[-1]
    kept = {d for d in stored if d.toordinal() % every == 0}
    wanted = sorted(d for d in kept | {newest} if base is None or d > base)
    if wanted:
        rows = read(spark, path).select(*LAST_ROW)
        if base is not None:
            rows = rows.where(F.col("snapshot_date") > F.lit(base)).unionByName(
                _last(spark, path, base))
        following = F.lead("snapshot_date").over(
            Window.partitionBy("event_id").orderBy("snapshot_date"))
        days = F.filter(F.array(*[F.lit(d) for d in wanted]), lambda d: (
            d >= F.col("snapshot_date")) & F.coalesce(d < F.col("next"), F.lit(True)))
        last = rows.select(*LAST_ROW, following.alias("next")).select(
            *LAST_ROW, F.explode(days).alias("as_of"))
        (last.hint("rebalance", "as_of").write.mode("overwrite").partitionBy("as_of")
         .option("partitionOverwriteMode", "dynamic").parquet(f"{path}/last"))
    for day in _days(spark, f"{path}/last", "as_of"):
        if day not in kept and day != newest:
            files.remove(spark, _folder(f"{path}/last", "as_of", day))
