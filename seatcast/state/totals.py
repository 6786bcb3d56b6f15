"""Additive totals over stored days.

A total is a sum over days, kept per key.  Its folder holds

    days/v<N>/snapshot_date=D/   the share of day D, as of update N
    total/v<N>/                  the sum of the shares of all days, as of update N
    commits/<N>.json             which update holds the valid share of each day

``update`` computes the shares of the replaced days from the stored rows of those
days alone, takes their former shares out of the total and adds the new ones; rows
whose count falls to zero go.  Nothing else of the history is read.  Sums are LONG
or DECIMAL, so taking out what was added before leaves no rounding behind.

An update takes effect with its commit file, which appears whole or not at all.
After a crash the last commit is still valid and the update can be run again; a
rerun of a finished update changes nothing, as it takes out what it adds.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files

# Updates whose files stay after a newer one, for readers that began before it.
KEEP = 2


@dataclass(frozen=True)
class Total:
    """``of_rows`` gives, for stored rows, one row per snapshot_date and ``keys`` with
    the ``sums`` columns; the first of them counts rows and is above zero."""

    name: str
    keys: tuple[str, ...]
    sums: tuple[str, ...]
    of_rows: Callable[[DataFrame], DataFrame]


def _commits(spark: SparkSession, path: str) -> list[int]:
    return [int(n[:-5]) for n in files.names(spark, f"{path}/commits") if n.endswith(".json")]


def current(spark: SparkSession, path: str) -> tuple[int, dict[_dt.date, int]]:
    """(last update, {day: the update that holds its share}); (0, {}) at first."""
    last = max(_commits(spark, path), default=0)
    if not last:
        return 0, {}
    days = json.loads(files.read_text(spark, f"{path}/commits/{last:012d}.json"))
    return last, {_dt.date.fromisoformat(d): v for d, v in days.items()}


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The committed total; None before the first update."""
    last, _ = current(spark, path)
    return spark.read.parquet(f"{path}/total/v{last}") if last else None


def update(spark: SparkSession, total: Total, path: str, rows: DataFrame,
           days: list[_dt.date]) -> int:
    """Bring the total up to date with ``rows``, the stored rows of ``days`` (none for
    a day that was emptied).  Returns the number of the update."""
    last, held = current(spark, path)
    number = last + 1
    shares = f"{path}/days/v{number}"
    columns = [*total.keys, *total.sums]
    made = total.of_rows(rows.where(F.col("snapshot_date").isin(days))).select(
        "snapshot_date", *columns)
    schema = made.drop("snapshot_date").schema
    (made.hint("rebalance", "snapshot_date").write.mode("overwrite")
     .partitionBy("snapshot_date").parquet(shares))
    written = [_dt.date.fromisoformat(n.partition("=")[2]) for n in files.names(spark, shares)
               if n.startswith("snapshot_date=")]

    def load(*paths: str) -> DataFrame:
        return spark.read.schema(schema).parquet(*paths)

    def share(v: int, day: _dt.date) -> str:
        return f"{path}/days/v{v}/snapshot_date={day.isoformat()}"

    parts = [load(*[share(number, d) for d in written]) if written
             else spark.createDataFrame([], schema)]
    if last:
        parts.append(load(f"{path}/total/v{last}"))
    gone = [share(held[d], d) for d in days if d in held]
    if gone:
        parts.append(load(*gone).select(*total.keys, *[(-F.col(c)).alias(c) for c in total.sums]))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    summed = (every.groupBy(*total.keys)
              .agg(*[F.sum(c).cast(schema[c].dataType).alias(c) for c in total.sums])
              .where(F.col(total.sums[0]) != 0))
    # the total is small next to the history: few files, split by size where it is not
    summed.hint("rebalance").write.mode("overwrite").parquet(f"{path}/total/v{number}")
    held = {d: v for d, v in held.items() if d not in days} | dict.fromkeys(written, number)
    files.commit_text(spark, f"{path}/commits/{number:012d}.json",
                      json.dumps({d.isoformat(): v for d, v in sorted(held.items())}))
    _tidy(spark, path, number, held)
    return number


def _tidy(spark: SparkSession, path: str, number: int, held: dict[_dt.date, int]) -> None:
    """Remove totals, commits and shares that no reader of the last updates needs."""
    old = number - KEEP
    for name in files.names(spark, f"{path}/total"):
        if int(name[1:]) <= old:
            files.remove(spark, f"{path}/total/{name}")
    for v in _commits(spark, path):
        if v <= old:
            files.remove(spark, f"{path}/commits/{v:012d}.json")
    valid = set(held.values())
    for name in files.names(spark, f"{path}/days"):
        if int(name[1:]) <= old and int(name[1:]) not in valid:
            files.remove(spark, f"{path}/days/{name}")
