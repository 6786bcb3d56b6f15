"""Repeated-substring removal by hash-compared suffix sort.

Every byte that lies in a string of ``size`` bytes which also starts earlier
(smaller id, or earlier in the same text) is removed.

1. Each text is cut into runs of neighbouring strings that share an anchor, a
   gram chosen by content (``suffixes.anchor_runs``): one narrow row of hashes
   per 35 bytes or so instead of one per byte.  Runs that recur within a slice
   of a task are settled there, before the shuffle.
2. Rows are dealt by gram and sorted.  Streaming through the order, a run equal
   to an earlier one is repeated as a whole.  Grams with one kind of run only
   are done: that is nearly all of a corpus.
3. Where runs with the same gram differ (edges of repeated passages, edits of
   near copies), the bytes around the anchor are fetched and the suffixes on
   both sides of it are sorted: a mergesort whose comparisons find common
   extensions by binary search on prefix polynomial hashes, verified on the
   bytes.  Runs in the two orders tell which strings are equal.
4. A gram with more than ``CROWD`` different runs is not gathered: its strings
   are hashed one by one and go through step 2 as rows of their own.
5. Spans are merged per document and cut out.

Defined cases: a null or empty text, or one shorter than ``size``, loses
nothing; a null id sorts before all others; ids are taken to be unique, and rows
that repeat an id and its text are one document, each row reported; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import suffixes
from .common import documents, lookup, materialize, text_slices, without

SIZE = 100
CROWD = 50_000
# Members sorted together in a task.
BATCH = 8192

# place holds the anchor's position and both distances, 7 bits each.
RUNS = "gram long, region long, doc long, place long"
# kind 0: bytes from start to end are repeated; 1: a run to be looked at.
FOUND = "kind int, gram long, doc long, start long, end long"
_FOUND = ["kind", "gram", "doc", "start", "end"]
# Marks a row of RUNS that already is a span: region is its end.
_SETTLED = -1


def _pack(anchor, left, right):
    return (anchor << 14) | (left << 7) | right


def _unpack(place):
    return place >> 14, (place >> 7) & 127, place & 127


def _found(kind, gram, doc, start, end) -> pa.RecordBatch:
    n = len(doc)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, "i4")), pa.array(np.broadcast_to(gram, n).astype("i8")),
         pa.array(doc), pa.array(start), pa.array(end)], names=_FOUND)


def _runs(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_slices(batches, ["doc", "text"]):
            parts = [suffixes.anchor_runs(t.encode(), size) for t in texts]
            rows = np.concatenate(parts)
            if not len(rows):
                continue
            gram, region = rows[:, 0], rows[:, 1]
            doc = np.repeat(np.array(ids, "i8"), [len(p) for p in parts])
            place = _pack(rows[:, 2], rows[:, 3], rows[:, 4])
            by = np.lexsort([place, doc, region, gram])
            gram, region, doc, place = gram[by], region[by], doc[by], place[by]
            again = np.zeros(len(by), bool)
            again[1:] = ((gram[1:] == gram[:-1]) & (region[1:] == region[:-1])
                         & ((doc[1:] != doc[:-1]) | (place[1:] != place[:-1])))
            keep = ~again
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[keep]) for c in (gram, region, doc, place)],
                names=["gram", "region", "doc", "place"])
            if again.any():
                a, left, right = _unpack(place[again])
                own = doc[again]
                start, end = a - left, a - right + size
                by = np.lexsort([start, own])
                own, start, end = own[by], start[by], end[by]
                for d in np.unique(own):
                    lo, hi = np.searchsorted(own, [d, d + 1]) if d < 2**63 - 1 else (
                        np.searchsorted(own, d), len(own))
                    s, e = suffixes.merge_spans(start[lo:hi], end[lo:hi])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(suffixes.mix((s + d).astype("u8")).view("i8")), pa.array(e),
                         pa.array(np.full(len(s), d, "i8")), pa.array(-1 - s)],
                        names=["gram", "region", "doc", "place"])

    return docs.mapInArrow(run, RUNS)


def _scan(runs: DataFrame, size: int) -> DataFrame:
    """FOUND rows of sorted ``runs``.  A negative place is a settled span from
    -1 - place to region.  The state carried between batches is one row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            gram, region, doc, place = (batch.column(c).to_numpy() for c in
                                        ("gram", "region", "doc", "place"))
            done = place < 0
            if done.any():
                yield _found(0, 0, doc[done], -1 - place[done], region[done])
                gram, region, doc, place = (c[~done] for c in (gram, region, doc, place))
            if not len(gram):
                continue
            new_gram, new_run = np.ones(len(gram), bool), np.ones(len(gram), bool)
            new_gram[1:] = gram[1:] != gram[:-1]
            new_run[1:] = new_gram[1:] | (region[1:] != region[:-1])
            if last is not None:
                new_gram[0] = gram[0] != last[0]
                new_run[0] = new_gram[0] or region[0] != last[1]
            last = (gram[-1], region[-1])
            a, left, right = _unpack(place)
            start, end = a - left, a - right + size
            again = ~new_run
            if again.any():
                yield _found(0, 0, doc[again], start[again], end[again])
            head = np.flatnonzero(new_run)
            if not len(head):
                continue
            if held is not None and not new_gram[head[0]]:
                yield _found(1, held[0], *(np.array([v]) for v in held[1:]))
            second = ~new_gram[head]
            follows = np.append(second[1:], False)
            look = head[second | follows]
            if len(look):
                yield _found(1, gram[look], doc[look], place[look], region[look])
            end_of = head[-1]
            held = None if second[-1] else (gram[end_of], doc[end_of], place[end_of],
                                            region[end_of])

    return (runs.repartition("gram").sortWithinPartitions("gram", "region", "doc", "place")
            .mapInArrow(run, FOUND))


def _contexts(docs: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """(gram, doc, place, bytes): the bytes of each member's run."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, own in text_slices(batches, ["doc", "text", "own"]):
            gram, doc, place, held = [], [], [], []
            for d, t, members in zip(ids, texts, own, strict=True):
                raw = t.encode()
                for m in members:
                    a, left, right = _unpack(m["place"])
                    gram.append(m["gram"])
                    doc.append(d)
                    place.append(m["place"])
                    held.append(raw[a - left:a - right + size])
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram, pa.int64()), pa.array(doc, pa.int64()),
                 pa.array(place, pa.int64()), pa.array(held, pa.binary())],
                names=["gram", "doc", "place", "bytes"])

    own = members.groupBy("doc").agg(F.collect_set(F.struct("gram", "place")).alias("own"))
    text = lookup(docs, members.select("doc").distinct(), "doc").dropDuplicates(["doc"])
    return text.join(own, "doc").select("doc", "text", "own").mapInArrow(
        run, "gram long, doc long, place long, bytes binary")


def _sorted_out(contexts: DataFrame, size: int) -> DataFrame:
    """Spans (doc, start, end) that earlier members of a gram repeat."""
    def settle(table: pa.Table) -> pa.RecordBatch:
        gram, doc, place = (table.column(c).to_numpy() for c in ("gram", "doc", "place"))
        a, left, right = _unpack(place)
        n, wide = len(gram), size - suffixes.GRAM
        before = np.full((n, wide), 256, "u2")
        after = np.full((n, size), 256, "u2")
        for i, raw in enumerate(table.column("bytes").to_pylist()):
            b = np.frombuffer(raw, "u1")
            before[i, :left[i]] = b[:left[i]][::-1]
            after[i, :len(b) - left[i]] = b[left[i]:]
        group = np.cumsum(np.concatenate([[0], gram[1:] != gram[:-1]])) if n else gram
        hit = suffixes.repeated_windows(group, left, right, before, after, size)
        # neighbouring distances of a member make one span
        hit = hit[np.lexsort([-hit[:, 1], hit[:, 0]])]
        new = np.ones(len(hit), bool)
        new[1:] = (hit[1:, 0] != hit[:-1, 0]) | (hit[1:, 1] != hit[:-1, 1] - 1)
        head = np.flatnonzero(new)
        tail = np.append(head[1:] - 1, len(hit) - 1)[:len(head)]
        who = hit[head, 0]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[who]), pa.array(a[who] - hit[head, 1]),
             pa.array(a[who] - hit[tail, 1] + size)], names=["doc", "start", "end"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
            if rows < BATCH:
                continue
            table = pa.concat_tables(held)
            gram = table.column("gram").to_numpy()
            whole = int(np.searchsorted(gram, gram[-1]))  # the last gram may go on
            if whole:
                yield settle(table.slice(0, whole).combine_chunks())
                table = table.slice(whole)
            held, rows = [table], table.num_rows
        if rows:
            yield settle(pa.concat_tables(held).combine_chunks())

    return (contexts.repartition("gram").sortWithinPartitions("gram", "doc", "place")
            .mapInArrow(run, "doc long, start long, end long"))


def _single_strings(contexts: DataFrame, size: int) -> DataFrame:
    """RUNS rows of every string of the members, one each."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram, doc, start = [], [], []
            for d, p, raw in zip(*(batch.column(c).to_pylist() for c in ("doc", "place", "bytes")),
                                 strict=True):
                a, left, _ = _unpack(p)
                prefix = suffixes.prefix_hashes(np.frombuffer(raw, "u1"))
                at = np.arange(len(raw) - size + 1)
                gram.append(suffixes.substring_hashes(prefix, at, at + size).view("i8"))
                doc.append(np.full(len(at), d, "i8"))
                start.append(a - left + at)
            if gram:
                g = np.concatenate(gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g), pa.array(g), pa.array(np.concatenate(doc)),
                     pa.array(_pack(np.concatenate(start), 0, 0))],
                    names=["gram", "region", "doc", "place"])

    return contexts.mapInArrow(run, RUNS)


def repeated_spans(docs: DataFrame, size: int = SIZE, crowd: int = CROWD) -> DataFrame:
    """(doc, start, end): spans of repeated bytes of ``docs`` (doc, text); they
    may overlap."""
    if size <= suffixes.GRAM or size > suffixes.GRAM + 127:
        raise ValueError(f"size must lie in {suffixes.GRAM + 1}..{suffixes.GRAM + 127}")
    found = materialize(_scan(_runs(docs, size), size), "repeats")
    spans = found.where("kind = 0").select("doc", "start", "end")
    members = found.where("kind = 1").select("gram", "doc", F.col("start").alias("place"))
    if members.isEmpty():
        return spans
    size_of = members.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    large = materialize(size_of.where(F.col("n") > crowd).select("gram"), "crowded-grams")
    if large.isEmpty():
        return spans.unionByName(_sorted_out(_contexts(docs, members, size), size))
    contexts = materialize(_contexts(docs, members, size), "contexts")
    split = _scan(_single_strings(contexts.join(large, "gram", "left_semi"), size), size)
    return (spans.unionByName(_sorted_out(contexts.join(large, "gram", "left_anti"), size))
            .unionByName(split.where("kind = 0").select("doc", "start", "end")))


RESULT = ("doc_id long, text string, n_bytes long, n_removed long, n_spans long, "
          "kept_sha256 string")


def remove_repeats(docs: DataFrame, size: int = SIZE, *, keep_text: bool = False,
                   crowd: int = CROWD, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, text (what is left; null unless
    ``keep_text``; bytes that no longer form a character become U+FFFD),
    n_bytes, n_removed, n_spans, kept_sha256 (of the bytes that are left)."""
    docs = documents(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    lowest = F.lit(-(2 ** 63)).cast("long")
    named = docs.select(F.coalesce("doc_id", lowest).alias("doc"), "doc_id", "text")
    spans = materialize(repeated_spans(named.select("doc", "text"), size, crowd)
                        .groupBy("doc").agg(F.collect_list(F.struct("start", "end"))
                                            .alias("spans")), "spans")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, cuts in text_slices(batches, ["doc_id", "text", "spans"]):
            out = [[] for _ in range(5)]
            for t, own in zip(texts, cuts, strict=True):
                raw = t.encode()
                start, end = suffixes.merge_spans(
                    np.array([s["start"] for s in own or []], "i8"),
                    np.array([s["end"] for s in own or []], "i8"))
                edges = [0, *np.stack([start, end], 1).ravel().tolist(), len(raw)]
                left = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                for c, v in zip(out, (left.decode("utf-8", "replace") if keep_text else None,
                                      len(raw), len(raw) - len(left), len(start),
                                      hashlib.sha256(left).hexdigest()), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(out[0], pa.string()),
                 *[pa.array(c, pa.int64()) for c in out[1:4]], pa.array(out[4], pa.string())],
                names=[f.split()[0] for f in RESULT.split(", ")])

    ids = spans.select("doc")
    nothing = F.lit(None).cast("array<struct<start:long,end:long>>").alias("spans")
    cut = lookup(named, ids, "doc").join(spans, "doc").select("doc_id", "text", "spans")
    whole = without(named, ids, "doc").select("doc_id", "text", nothing)
    return cut.mapInArrow(run, RESULT).unionByName(whole.mapInArrow(run, RESULT))
