"""Quality rules: compression bands.

Zstandard's ratio (compressed over plain bytes) of the whole document and of
its fixed chunks must lie within limits that depend on the length: repetitive
text compresses too well, encoded or random text hardly at all.  A document is
rejected if the whole ratio leaves its band or if more than half of its chunks
leave theirs.  Two plain rules come first: fewer than 50 words, or more than
half of the words in repeated three-word windows.

Words are runs of bytes other than space and 0x09-0x0D.

Defined cases: a null or empty text has no words and is rejected; repeated rows
give equal rows; null ids stay; an empty table gives no rows; a last chunk
shorter than ``MIN_CHUNK`` is judged only with the whole text; extra columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, ship_package, text_slices, tidy

MIN_WORDS = 50
REPEAT_PERCENT = 50
LEVEL = 3
CHUNK = 2048
MIN_CHUNK = 512
BAD_CHUNK_SHARE = 0.5

# (bytes, lowest ratio, highest ratio); between two lengths the limits are
# interpolated over the logarithm of the length.  Set a little below what the
# plain prose of four languages reaches, which falls with the length because
# one long frame reuses more.
BANDS = [(64, 0.40, 2.00), (200, 0.47, 1.20), (500, 0.47, 0.95), (1000, 0.45, 0.85),
         (2000, 0.435, 0.80), (5000, 0.41, 0.76), (15000, 0.385, 0.74), (50000, 0.37, 0.72),
         (200000, 0.35, 0.70)]

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, ratio double, "
          "n_chunks long, n_bad_chunks long")
_ARROW = pa.schema([("doc_id", pa.int64())] + [(c, pa.int64()) for c in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("ratio", pa.float64()),
    ("n_chunks", pa.int64()), ("n_bad_chunks", pa.int64())])

_X = np.log([b[0] for b in BANDS])
_LOW = np.array([b[1] for b in BANDS])
_HIGH = np.array([b[2] for b in BANDS])


def limits(n_bytes: int) -> tuple[float, float]:
    """Lowest and highest allowed ratio for a text of this length."""
    x = np.log(max(n_bytes, 1))
    return float(np.interp(x, _X, _LOW)), float(np.interp(x, _X, _HIGH))


def n_repeat_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    distinct = set(windows)
    if len(distinct) == len(windows):
        return 0
    counts = Counter(windows)
    covered, reach = 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + 3 - max(reach, i)
            reach = i + 3
    return covered


def measure(text: str, compressor) -> tuple:
    """The columns after doc_id for one text."""
    raw = text.encode()
    words = raw.split()  # bytes.split: exactly space and 0x09-0x0D
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, "#*$%&|<>"))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeat = n_repeat_words(words)
    failed = n < MIN_WORDS or 100 * repeat > REPEAT_PERCENT * n
    ratio, chunks, bad = 0.0, 0, 0
    if raw:
        ratio = len(compressor.compress(raw)) / len(raw)
        for at in range(0, len(raw), CHUNK):
            part = raw[at:at + CHUNK]
            if len(part) >= MIN_CHUNK:
                low, high = limits(len(part))
                chunks += 1
                bad += not low <= len(compressor.compress(part)) / len(part) <= high
    low, high = limits(len(raw))
    kept = not failed and low <= ratio <= high and bad <= BAD_CHUNK_SHARE * chunks
    return n, chars, symbols, dup, repeat, failed, kept, ratio, chunks, bad


def compression_bands(docs: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row per document with its counts, ratios and verdict.  A narrow map:
    no shuffle, and a task holds a few megabytes of text at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for ids, texts in text_slices(batches, ["doc_id", "text"]):
            rows = [measure(t, compressor) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip([ids, *zip(*rows, strict=True)], _ARROW,
                                                     strict=True)], schema=_ARROW)

    return documents(docs, id_col, text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), SCHEMA)


def keep_passing(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.  Rows
    are filtered in place, so repeated rows and null ids need no join."""
    ship_package(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            texts = (x.as_py() or "" for x in batch.column(text_col))
            yield batch.filter(pa.array([measure(t, compressor)[6] for t in texts], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
