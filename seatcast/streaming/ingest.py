"""Incremental ingestion of landed pages (Structured Streaming).

``readStream`` over the landing folder picks up new page files; each
micro-batch (``foreachBatch``) replaces the snapshot days it touches.  A day
can arrive in several micro-batches (a late page), and replacing a day with
only the new batch's pages would lose the earlier ones, so the batch function
re-reads *all* landed pages of the touched days (given as folders, so no other
day is listed) and replaces those days with that full set.  Reprocessing is
idempotent: a rerun over the same files gives the same store.  The file-source checkpoint records which files were seen, so a
restart after a lost driver or executor resumes without duplicates.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import pages, store


def _replace_touched_days(spark: SparkSession, landing_root: str, store_path: str,
                          ingested_at: _dt.datetime | None, dedupe: bool):
    def handle(batch: DataFrame, epoch_id: int) -> None:
        # the touched days: a handful of dates per micro-batch
        days = sorted(r["snapshot_date"] for r in
                      batch.select("snapshot_date").filter(F.col("snapshot_date").isNotNull())
                      .distinct().collect())
        if days:
            rows = pages.landed_rows(spark, landing_root, days)
            store.upsert_days(rows, store_path, days=days, dedupe=dedupe,
                              ingested_at=ingested_at)
    return handle


def start_ingest_stream(spark: SparkSession, landing_root: str, store_path: str,
                        checkpoint: str, *, available_now: bool = True,
                        processing_time: str | None = None, dedupe: bool = False,
                        files_per_trigger: int | None = None,
                        ingested_at: _dt.datetime | None = None) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is landed and
    stops, otherwise it polls every ``processing_time``.  ``files_per_trigger``
    bounds a micro-batch, so a first run over a large landing is not one batch;
    ``dedupe`` keeps one row per key instead of failing on a repeated one."""
    reader = spark.readStream.schema(pages.LANDED_PAGE).option("basePath", landing_root)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    writer = (reader.json(landing_root).writeStream
              .foreachBatch(_replace_touched_days(spark, landing_root, store_path, ingested_at,
                                                  dedupe))
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
