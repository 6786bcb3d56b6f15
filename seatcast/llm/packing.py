"""Best-fit packing with swap-based local search.

Documents become pieces of at most ``capacity`` ids; pieces are packed into
sequences of at most ``capacity`` ids, as few as possible.

* Pieces are dealt at random over groups of about ``GROUP`` open pieces.  Each
  group is packed by best fit, longest piece first.
* Local search then works on the underfull bins of the group: it moves one
  piece, exchanges one for one, or two for one, whenever that raises the sum of
  the squared fills.  Fill gathers in fewer bins until some are empty.
* The underfull bins of all groups are dealt and packed again, in fewer groups,
  until one group is left, so the loss does not grow with the number of groups.
  A round takes at most ``SHRINK`` of the last one's open pieces, those of the
  emptiest bins; fuller bins stay as they are.  So rounds end also for pieces
  that fit with nothing, and all rounds together cost a fixed multiple of the
  first.

A group has a bounded number of pieces whatever the data looks like, because
pieces are dealt by their place in the written piece table and not by a key.
Equal texts and hot sources spread evenly.

Defined cases: a null or empty text is one piece that holds the end id alone;
repeated rows are packed once each; a null id stays null; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import SLICE_BYTES, documents, materialize, text_slices, tidy

CAPACITY = 1024
GROUP = 8192
# Bins filled below this share go to the next round.
LOOSE = 0.98
# A round has at most this share of the open pieces of the round before.
SHRINK = 0.75

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, "
          "dealt_part int, dealt_row long")
PLACED = PIECES + ", sequence_id long, offset long, fill long"


def pieces(docs: DataFrame, tokenizer_path: str, *, end_id: int, capacity: int = CAPACITY,
           keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text",
           known_bytes: int = tokens.KNOWN_BYTES, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per piece.  Only documents longer than ``capacity`` are cut; all
    their pieces have ``capacity`` ids but the first, which may have fewer.  Texts
    are encoded ``slice_bytes`` at a time: smaller slices take less memory and, as
    words recur less within them, more time."""
    end = np.array([end_id], "<u4").tobytes()
    row = [f.split()[0] for f in PIECES.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer_path, "space", known_bytes)
        part, n = TaskContext.get().partitionId(), 0
        for ids, texts in text_slices(batches, ["doc_id", "text"], limit=slice_bytes):
            out = {k: [] for k in row}
            for doc, raw in zip(ids, enc.encode(texts), strict=True):
                raw += end
                total = len(raw) // 4
                start, stop, k = 0, total % capacity or min(total, capacity), 0
                while start < total:
                    own = raw[4 * start:4 * stop]
                    for c, v in zip(row, (doc, k, start, stop - start, zlib.crc32(own),
                                          own if keep_ids else None, part, n), strict=True):
                        out[c].append(v)
                    start, stop, k, n = stop, stop + capacity, k + 1, n + 1
            yield pa.RecordBatch.from_pydict(
                out, schema=pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()),
                                       ("start", pa.int64()), ("length", pa.int64()),
                                       ("ids_crc32", pa.int64()), ("ids", pa.binary()),
                                       ("dealt_part", pa.int32()), ("dealt_row", pa.int64())]))

    return documents(docs, id_col, text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of positions in ``lengths``: longest first, each to the
    fullest bin that still takes it."""
    bins: list[list[int]] = []
    by_gap: dict[int, list[int]] = {}
    gaps = 0  # bit g is set if some bin has g ids left
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        if at := gaps >> n:
            gap = n + (at & -at).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps ^= 1 << gap
        else:
            gap, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if gap > n:
            by_gap.setdefault(gap - n, []).append(b)
            gaps |= 1 << (gap - n)
    return bins


def local_search(bins: list[list[int]], lengths: list[int], capacity: int,
                 passes: int = 40) -> list[list[int]]:
    """Raise the sum of squared fills by moves and exchanges between underfull
    bins.  Stops when the bin count meets its lower bound, when a pass finds
    nothing, or after ``passes`` passes; every step keeps a valid packing."""
    least = -(-sum(lengths) // capacity)
    fill = [sum(lengths[i] for i in b) for b in bins]
    where: dict[int, set[int]] = {}  # length -> bins that hold a piece of it
    have = 0  # bit n is set if some underfull bin holds a piece of n ids

    def enter(b: int) -> None:
        nonlocal have
        for i in bins[b]:
            where.setdefault(lengths[i], set()).add(b)
            have |= 1 << lengths[i]

    def leave(b: int) -> None:
        nonlocal have
        for i in bins[b]:
            n = lengths[i]
            if n in where:
                where[n].discard(b)
                if not where[n]:
                    del where[n]
                    have &= ~(1 << n)

    def donor(n: int, a: int, other: int = -1) -> int | None:
        """A bin no fuller than ``a`` that holds a piece of ``n`` ids."""
        return next((b for b in where.get(n, ()) if b not in (a, other) and fill[b] <= fill[a]),
                    None)

    def take(b: int, n: int) -> int:
        i = next(i for i in bins[b] if lengths[i] == n)
        bins[b].remove(i)
        fill[b] -= n
        return i

    def put(b: int, i: int) -> None:
        bins[b].append(i)
        fill[b] += lengths[i]

    def below(limit: int, floor: int) -> Iterator[int]:
        """Lengths present, from ``limit`` down to more than ``floor``."""
        mask = have & ((1 << (limit + 1)) - 1)
        while (n := mask.bit_length() - 1) > floor:
            yield n
            mask ^= 1 << n

    def gain(changes: dict[int, int]) -> int:
        """Rise of the sum of squared fills; negative if a bin would overflow."""
        if any(fill[b] + d > capacity for b, d in changes.items()):
            return -1
        return sum(d * (2 * fill[b] + d) for b, d in changes.items())

    def one_for_one(a: int, gap: int) -> tuple:
        """The best (gained, piece given, [(bin, piece taken)], taker of the
        given piece); a given piece of 0 ids is a move."""
        best = (0, 0, (), -1)
        for x in [0, *sorted({lengths[i] for i in bins[a]})]:
            for y in below(x + gap, x + best[0]):
                b = donor(y, a)
                if b is not None:  # y > x and b is no fuller: always a rise
                    best = (y - x, x, ((b, y),), b)
                    break
        return best

    def two_for_one(a: int, gap: int, best: tuple) -> tuple:
        for x in sorted({lengths[i] for i in bins[a]}):
            for y in below((x + gap) // 2, 0):
                z = next(iter(below(x + gap - y, max(y - 1, x + best[0] - y))), None)
                b = None if z is None else donor(y, a)
                c = None if b is None else donor(z, a, b)
                if c is None:
                    continue
                d = y + z - x
                for taker in (c, b):
                    if gain({a: d, b: -y + x * (taker == b), c: -z + x * (taker == c)}) > 0:
                        best = (d, x, ((b, y), (c, z)), taker)
                        break
                if best[0] == gap:
                    return best
        return best

    def improve(a: int) -> bool:
        gap = capacity - fill[a]
        best = one_for_one(a, gap)
        if best[0] < gap:
            best = two_for_one(a, gap, best)
        _, x, given, taker = best
        if not given:
            return False
        touched = {a, *(b for b, _ in given)}
        for b in touched:
            leave(b)
        got = [take(b, y) for b, y in given]
        if x:
            put(taker, take(a, x))
        for i in got:
            put(a, i)
        for b in touched:
            if 0 < fill[b] < capacity:
                enter(b)
        return True

    for b in range(len(bins)):
        if fill[b] < capacity:
            enter(b)
    for _ in range(passes):
        if sum(f > 0 for f in fill) <= least:
            break
        better = False
        for a in sorted((b for b in range(len(bins)) if 0 < fill[b] < capacity),
                        key=lambda b: -fill[b]):
            while 0 < fill[a] < capacity and improve(a):
                better = True
        if not better:
            break
    return [b for b in bins if b]


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best fit, then local search; bins as lists of positions."""
    return local_search(best_fit(lengths, capacity), lengths, capacity)


def _packer(capacity: int, round_no: int):
    def run(key, table):
        order = [("dealt_part", "ascending"), ("dealt_row", "ascending")]
        table = table.sort_by(order)
        lengths = table.column("length").to_pylist()
        n = len(lengths)
        bin_of, offset, fill = np.zeros(n, "i8"), np.zeros(n, "i8"), np.zeros(n, "i8")
        for k, members in enumerate(pack_lengths(lengths, capacity)):
            at = 0
            for i in members:
                bin_of[i], offset[i] = k, at
                at += lengths[i]
            fill[members] = at
        # unique over rounds and groups: 6 bits of round, 33 of group, 24 of bin
        base = (round_no << 57) | (key[0].as_py() << 24)
        for name, values in (("sequence_id", base + bin_of), ("offset", offset), ("fill", fill)):
            table = table.append_column(name, pa.array(values, pa.int64()))
        return table.drop(["grp"])

    return run


def emptiest(levels: dict[int, int], most: float) -> tuple[int, int]:
    """(fill, pieces): the highest fill so that bins up to it have ``most``
    pieces at most, and how many they have; ``levels`` is pieces by fill."""
    top = taken = 0
    for fill in sorted(levels):
        if taken + levels[fill] > most:
            break
        top, taken = fill, taken + levels[fill]
    return top, taken


def pack(docs: DataFrame, tokenizer_path: str, *, end_id: int, capacity: int = CAPACITY,
         group: int = GROUP, keep_ids: bool = False, id_col: str = "doc_id",
         text_col: str = "text", known_bytes: int = tokens.KNOWN_BYTES,
         slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Where each piece goes: doc_id, piece, start, length, ids_crc32, ids (null
    unless ``keep_ids``), sequence_id, offset.  See the module's docstring."""
    cut = materialize(pieces(docs, tokenizer_path, end_id=end_id, capacity=capacity,
                             keep_ids=keep_ids, id_col=id_col, text_col=text_col,
                             known_bytes=known_bytes, slice_bytes=slice_bytes), "pieces")
    placed, todo, round_no = [], cut, 0
    n = todo.where(F.col("length") < capacity).count()
    while True:
        groups = max(1, -(-n // group))
        dealt = todo.withColumn(
            "grp", F.pmod(F.xxhash64("dealt_part", "dealt_row", F.lit(round_no)), F.lit(groups)))
        now = materialize(dealt.groupBy("grp").applyInArrow(_packer(capacity, round_no), PLACED),
                          "packed")
        levels = {} if groups == 1 else dict(  # at most ``capacity`` rows
            now.where(F.col("fill") < LOOSE * capacity).groupBy("fill").count().collect())
        top, n = emptiest(levels, SHRINK * n)
        if not n:
            placed.append(now)
            break
        again = F.col("fill") <= top
        placed.append(now.where(~again))
        todo, round_no = now.where(again).drop("sequence_id", "offset", "fill"), round_no + 1
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    return out.drop("dealt_part", "dealt_row", "fill")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids binary) from ``pack(..., keep_ids=True)``; a
    group is one sequence and so at most ``capacity`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return (packed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id",
                    F.aggregate("parts", F.lit(0).cast("long"),
                                lambda a, p: a + p["length"]).alias("length"),
                    F.aggregate("parts", F.lit(b""),
                                lambda a, p: F.concat(a, p["ids"])).alias("ids")))
