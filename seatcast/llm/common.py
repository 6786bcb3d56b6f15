"""Helpers shared by the document operators."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import html
import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Bytes of text that a task turns into Python objects at a time.
SLICE_BYTES = 4 << 20


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package (as ``--py-files`` would), once per
    application, so that tasks find it wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_seatcast_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="seatcast-code-"), "seatcast.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(target)
    sc._seatcast_shipped = True


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made different from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of ``docs``: a null text is the empty text, every other
    column goes, so extra columns cannot clash with an operator's own."""
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts
    the lineage, and a lost executor cannot lose the rows."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Narrow rows that are sent to every executor at most; a row of two longs takes
# some 60 bytes there.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked to be broadcast if it has at most ``limit`` rows; with
    more rows the join shuffles both sides."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def lookup(df: DataFrame, ids: DataFrame, key: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``ids`` (one distinct column)."""
    return df.join(small(ids, limit), key, "left_semi")


def without(df: DataFrame, ids: DataFrame, key: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``df`` whose ``key`` is not in ``ids``."""
    return df.join(small(ids, limit), key, "left_anti")


def text_slices(batches: Iterable[pa.RecordBatch], columns: list[str], text: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[list[list]]:
    """Columns of ``batches`` as Python lists, in slices of about ``limit``
    bytes of text, so one Arrow batch of long texts is not held twice."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.binary_length(batch.column(text)).to_pylist()
        begin, held = 0, 0
        for i, n in enumerate(sizes):
            held += n or 0
            if held >= limit or i == len(sizes) - 1:
                part = batch.slice(begin, i + 1 - begin)
                yield [part.column(c).to_pylist() for c in columns]
                begin, held = i + 1, 0


_ZEROS = re.compile("&#0{8,}")
_NO_CHARACTER = re.compile("&#0*[1-9][0-9]{7,};?")


def unescape(markup: str) -> str:
    """Character references decoded; a decimal one beyond all characters is the
    replacement character however many digits it has."""
    if "&" not in markup:
        return markup
    return html.unescape(_NO_CHARACTER.sub("\ufffd", _ZEROS.sub("&#0", markup)))


def give_back() -> None:
    """Return freed memory of this process to the system: a worker process serves
    many tasks, and what one of them used at its peak stays mapped otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library: nothing to do
        pass


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextlib.contextmanager
def small_batches(spark: SparkSession, most: int = SLICE_BYTES) -> Iterator[None]:
    """What runs within it sends rows to Python workers ``most`` bytes at a time.  Else
    a batch is some 10,000 rows, and the buffers that both sides keep for it in every
    task grow with the length of the texts."""
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, most)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, before)


def tidy(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """``run`` for ``mapInArrow``, which gives freed memory back when a task ends."""
    @functools.wraps(run)
    def task(batches: Iterable) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
