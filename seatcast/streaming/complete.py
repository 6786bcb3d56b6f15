"""Incremental ingestion that reads every landed file once and stores a day once.

Two streams, each with its own checkpoint below one work folder:

* ``stage_pages``   parses new page files and appends their pages to a Parquet table
                    partitioned by day (``pages/``); no other step reads the landing
* ``release_days``  follows that table by its page numbers alone; a stateful operator
                    holds, per day, the numbers seen for each city and releases the day
                    when every city that has shown up is complete, or when nothing new
                    has come for ``patience``; the released days are then replaced in
                    the store from their staged pages

So a day that arrives in many micro-batches is flattened and written once, not once
per batch.  A page, city or repeated page that comes after the release opens the day
again; it is released anew when complete (or after ``patience``), from all its pages.

Time is the time pages were staged, so nothing waits for a clock: a day that stays
incomplete is released when pages of any day have been staged ``patience`` later.
The state is a few numbers per page, keyed by day; ``forget`` after its last page a
complete day's state goes (a later page then makes it wait for ``patience`` once).
A restart after a lost driver repeats at most the release of the days it was at.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import ntz_literal
from ..sources import pages, store

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

RELEASES = "snapshot_date date, status string, cities int, pages long"


def _started(writer, available_now: bool, processing_time: str | None) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def stage_pages(spark: SparkSession, landing_root: str, work: str, *,
                available_now: bool = True, processing_time: str | None = None,
                files_per_trigger: int | None = None,
                staged_at: _dt.datetime | None = None) -> StreamingQuery:
    """Start appending landed pages to ``work``/pages.  ``staged_at`` stands in for the
    time of the micro-batch (for reruns of old landings)."""
    reader = (spark.readStream.schema(pages.LANDED_PAGE).option("basePath", landing_root)
              .option("columnNameOfCorruptRecord", pages.UNREADABLE))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    stamp: Column = (F.current_timestamp() if staged_at is None
                     else ntz_literal(staged_at).cast("timestamp"))
    landed = reader.json(landing_root).select(
        "*", F.col("_metadata.file_modification_time").alias("landed_at"),
        F.col("_metadata.file_path").alias("landed_file"), stamp.alias("staged_at"))
    writer = (landed.writeStream.format("parquet").outputMode("append")
              .partitionBy("snapshot_date").option("path", f"{work}/pages")
              .option("checkpointLocation", f"{work}/stage-checkpoint"))
    return _started(writer, available_now, processing_time)


def staged(spark: SparkSession, work: str, days: list[_dt.date] | None = None) -> DataFrame:
    """Staged pages, of ``days`` alone if given (a partition filter)."""
    found = spark.read.parquet(f"{work}/pages")
    return found if days is None else found.where(F.col("snapshot_date").isin(days))


def _day_tracker(forget_ms: int):
    """The stateful operator; built here so that it travels to the workers whole."""
    from pyspark.sql import Row
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class DayTracker(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.seen = handle.getMapState("seen", "city string, number int", "times int")
            self.cities = handle.getMapState("cities", "city string",
                                             "announced int, pages int, highest int")
            self.day = handle.getValueState("day", "released boolean, pages long")

        def _complete(self) -> tuple[bool, int]:
            done, n = True, 0
            for _, (announced, seen, highest) in self.cities.iterator():
                n += 1
                done = done and seen >= max(announced, highest + 1)
            return done, n

        def _wake_at(self, ms: int) -> None:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            self.handle.registerTimer(ms)

        def _release(self, key, status: str, cities: int):
            pages_ = self.day.get()[1] if self.day.exists() else 0
            self.day.update((True, pages_))
            return Row(snapshot_date=key[0], status=status, cities=cities, pages=pages_)

        def handleInputRows(self, key, rows, timerValues):
            released, total = self.day.get() if self.day.exists() else (False, 0)
            last = 0
            for row in rows:
                last = max(last, row.staged_ms)
                if row.number is None:
                    continue
                at, city = (row.city, row.number), (row.city,)
                announced, count, highest = (self.cities.getValue(city)
                                             if self.cities.containsKey(city) else (0, 0, -1))
                if self.seen.containsKey(at):
                    self.seen.updateValue(at, (self.seen.getValue(at)[0] + 1,))
                else:
                    self.seen.updateValue(at, (1,))
                    count, total = count + 1, total + 1
                self.cities.updateValue(city, (max(announced, row.announced or 0), count,
                                               max(highest, row.number)))
            self.day.update((released, total))
            done, cities = self._complete()
            if done and cities:
                self._wake_at(last + forget_ms)
                yield self._release(key, "late" if released else "complete", cities)
            else:
                self._wake_at(last)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            done, cities = self._complete()
            if done and cities:
                for state in (self.seen, self.cities, self.day):
                    state.clear()
            else:
                yield self._release(key, "timed out", cities)

        def close(self) -> None:
            pass

    return DayTracker()


def releases(spark: SparkSession, work: str, *, patience: str = "12 hours",
             forget: _dt.timedelta = _dt.timedelta(days=30),
             files_per_trigger: int | None = None) -> DataFrame:
    """The stream of released days (``RELEASES``)."""
    reader = spark.readStream.schema(spark.read.parquet(f"{work}/pages").schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    numbers = reader.parquet(f"{work}/pages").select(
        "snapshot_date", F.coalesce("city", F.lit("")).alias("city"),
        F.col("page.number").alias("number"), F.col("page.totalPages").alias("announced"),
        "staged_at", F.unix_millis("staged_at").alias("staged_ms"))
    return (numbers.withWatermark("staged_at", patience).groupBy("snapshot_date")
            .transformWithState(_day_tracker(int(forget.total_seconds() * 1000)), RELEASES,
                                "append", "EventTime"))


def release_days(spark: SparkSession, work: str, store_path: str, *, patience: str = "12 hours",
                 available_now: bool = True, processing_time: str | None = None,
                 files_per_trigger: int | None = None, dedupe: bool = False,
                 ingested_at: _dt.datetime | None = None,
                 on_release: Callable[[list[_dt.date]], None] | None = None) -> StreamingQuery:
    """Start replacing released days in the store.  ``on_release`` gets the replaced
    days of each micro-batch, for what is kept between days (``plans.daily.refresh``).
    Needs at least one staged page (``stage_pages``)."""

    def handle(batch: DataFrame, epoch_id: int) -> None:
        # a handful of dates per micro-batch
        days = sorted({r["snapshot_date"] for r in batch.select("snapshot_date").collect()})
        if not days:
            return
        events = pages.page_events(staged(spark, work, days),
                                   last=F.struct("landed_at", "landed_file"))
        rows = pages.flat_rows(events)
        done = store.upsert_days(rows, store_path, days=days, dedupe=dedupe,
                                 ingested_at=ingested_at)
        if on_release is not None and done["replaced"]:
            on_release(done["replaced"])

    found = releases(spark, work, patience=patience, files_per_trigger=files_per_trigger)
    writer = (found.writeStream.foreachBatch(handle)
              .option("checkpointLocation", f"{work}/release-checkpoint"))
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # state of this kind needs it; read at the start
    try:
        return _started(writer, available_now, processing_time)
    finally:
        spark.conf.set(PROVIDER, before)
