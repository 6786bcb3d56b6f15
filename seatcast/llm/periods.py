"""Periodic runs of words, from Lyndon arrays by Baier's grouping.

A run is a stretch of consecutive words with smallest period q and at least
max(6, 4q) words that no neighbouring word extends keeping period q.

* Suffixes start in groups by their first word.  Groups are handled from the
  highest down; each member's nearest suffix to the left in a lower group takes the
  handled group's context behind its own and moves to a new group right above its
  old one.  When a suffix's group is handled, its context is the longest Lyndon word
  that starts there (``lyndon_array``): phase one of Baier's suffix sorter, no
  suffix array is made.
* This is done under an order of the words and under its reverse.  Every run has,
  under one of the two, Lyndon words of its period's length at each of its periods.
* A Lyndon word that recurs twice right behind itself is extended to both sides by
  the longest common extensions of its place and the next one: prefix hashes and
  binary search, then compared word by word.

Each text is one row of a narrow map; a task handles slices of some 4 MB of text
together.  Before the grouping, words that lie in no repeated five-word stretch of
their part of the text go, which cuts the rest into parts: every five words of a run
recur in the run, one period away, so each run lies whole in one part.

Defined cases: a null, empty or blank text has no words and no runs, its collapsed
text is empty; texts of any length are handled whole, in memory linear in the
longest one; ties between runs do not matter here, all are given; repeated rows give
one row each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, text_slices

MIN_WORDS, MIN_PERIODS = 6, 4
# Words in the stretches that must recur: at least two of them lie in every run.
GRAM = 5

SCHEMA = ("doc_id long, n_words long, "
          "runs array<struct<start:long,length:long,period:long>>, collapsed string")
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_MULTIPLIER = 0x9E3779B97F4A7C15  # an odd number: powers of it never vanish


def lyndon_array(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place; ``rank`` has
    every number from 0 up to its largest."""
    n, groups = len(rank), int(rank.max()) + 1 if len(rank) else 0
    order = np.argsort(rank, kind="stable") + 1  # places count from 1; 0 is no place
    members = [m.tolist() for m in np.split(order, np.searchsorted(rank[order - 1],
                                                                   np.arange(1, groups)))]
    length = [1] * groups
    below, above = list(range(-1, groups - 1)), list(range(1, groups + 1))
    group = [-1, *rank.tolist(), -1]
    left, right = list(range(-1, n + 1)), list(range(1, n + 3))
    found = [0] * (n + 1)
    g = groups - 1
    while g >= 0:
        own = length[g]
        moved: dict[tuple[int, int], list[int]] = {}
        last = times = 0
        for i in members[g]:
            if group[i] != g:  # has moved to a higher group
                continue
            found[i] = own
            p, r = left[i], right[i]
            right[p], left[r] = r, p
            if p == last:
                times += 1
                continue
            if last:
                moved.setdefault((group[last], times), []).append(last)
            last, times = p, 1
        if last:
            moved.setdefault((group[last], times), []).append(last)
        members[g] = ()
        # more repetitions rank higher, so the one put in last is the one with fewest
        for key in sorted(moved, reverse=True) if len(moved) > 1 else moved:
            old, new = key[0], len(length)
            length.append(length[old] + key[1] * own)
            members.append(moved[key])
            for i in moved[key]:
                group[i] = new
            below.append(old)
            above.append(above[old])
            below[above[old]] = new
            above[old] = new
        g = below[g]
    return np.array(found[1:], "i8")


class _Extensions:
    """Longest common extensions of places of ``x``, by prefix hashes."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        with np.errstate(over="ignore"):
            self.power = np.full(self.n + 1, _MULTIPLIER, "u8")
            self.power[0] = 1
            self.power = np.cumprod(self.power, dtype="u8")
            self.total = np.zeros(self.n + 1, "u8")
            np.cumsum(values * self.power[:-1], dtype="u8", out=self.total[1:])

    def same(self, i: np.ndarray, gap: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Do the hashes of n values from i on and from i + gap on agree?"""
        with np.errstate(over="ignore"):
            a = (self.total[i + n] - self.total[i]) * self.power[gap]
            return a == self.total[i + gap + n] - self.total[i + gap]

    def _longest(self, most: np.ndarray, agree) -> np.ndarray:
        got = np.zeros(len(most), "i8")
        for bit in reversed(range(int(most.max(initial=0)).bit_length())):
            more = got + (1 << bit)
            at = np.nonzero(more <= most)[0]
            at = at[agree(at, more[at])]
            got[at] = more[at]
        return got

    def forward(self, i: np.ndarray, gap: np.ndarray) -> np.ndarray:
        return self._longest(self.n - i - gap, lambda at, n: self.same(i[at], gap[at], n))

    def backward(self, i: np.ndarray, gap: np.ndarray) -> np.ndarray:
        return self._longest(i.copy(), lambda at, n: self.same(i[at] - n, gap[at], n))


def _scramble(x: np.ndarray) -> np.ndarray:
    """64-bit values in place of numbers, so that sums of them rarely agree."""
    with np.errstate(over="ignore"):
        x = (x.astype("u8") + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def _extent(x: np.ndarray, i: int, p: int) -> tuple[int, int]:
    """(start, end) of the stretch around i with period p, compared value by value."""
    differ = np.nonzero(x[:-p] != x[p:])[0]
    k = int(np.searchsorted(differ, i))
    start = int(differ[k - 1]) + 1 if k else 0
    return start, (int(differ[k]) if k < len(differ) else len(x) - p) + p


def runs_of(x: np.ndarray, hashes: np.ndarray | None = None) -> np.ndarray:
    """Rows (start, length, period) of all runs in ``x``, by start, then period.
    Negative values occur once each and end every stretch; ``hashes`` stand for the
    values in the prefix hashes."""
    rank = np.unique(x, return_inverse=True)[1]
    cuts = int((x < 0).sum())
    ext = _Extensions(_scramble(rank) if hashes is None else hashes)
    n, found = len(x), []
    for order in (rank, np.where(x < 0, rank, rank.max(initial=0) + cuts - rank)):
        p = lyndon_array(order)
        i = np.nonzero(np.arange(n) + 3 * p <= n)[0]
        i = i[(p[i + p[i]] == p[i]) & (x[i] >= 0)]
        i = i[p[i + 2 * p[i]] == p[i]]
        q = p[i]
        start, end = i - ext.backward(i, q), i + q + ext.forward(i, q)
        long = end - start >= np.maximum(MIN_WORDS, MIN_PERIODS * q)
        found.append(np.stack([start[long], end[long], q[long], i[long]], 1))
    got = np.concatenate(found)
    _, first = np.unique(got[:, :3], axis=0, return_index=True)
    sure = set()
    for k in first.tolist():
        start, end, q, _ = got[k].tolist()
        if np.array_equal(x[start:end - q], x[start + q:end]):
            sure.add((start, end - start, q))
            continue
        for i in got[(got[:, :3] == got[k, :3]).all(1), 3].tolist():  # the hashes lied
            start, end = _extent(x, i, q)
            if end - start >= max(MIN_WORDS, MIN_PERIODS * q):
                sure.add((start, end - start, q))
    return np.array(sorted((s, n, q) for s, n, q in sure), "i8").reshape(-1, 3)


def _repeating(x: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Which values lie in a stretch of ``GRAM`` values of their part that recurs in
    the part (equal hashes are enough: this only leaves more to do)."""
    n = len(x) - GRAM + 1
    covered = np.zeros(len(x) + 1, "i8")
    if n < 2:
        return covered[:-1] > 0
    value = _scramble(x)
    with np.errstate(over="ignore"):
        key = _scramble(part[:n])
        for k in range(GRAM):
            key = (key ^ value[k:n + k]) * np.uint64(_MULTIPLIER)
            key ^= key >> np.uint64(31)
    whole = np.nonzero(part[:n] == part[GRAM - 1:])[0]
    key = key[whole]
    order = np.argsort(key)
    equal = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][equal]] = twice[order[:-1][equal]] = True
    at = whole[twice]
    covered[at] += 1
    covered[at + GRAM] -= 1
    return np.cumsum(covered)[:-1] > 0


def runs_of_texts(texts: list[list[int]]) -> list[list[tuple[int, int, int]]]:
    """Runs of each text; a text is its words' numbers."""
    sizes = np.array([len(t) for t in texts], "i8")
    starts = np.cumsum(sizes) - sizes
    x = np.fromiter((w for t in texts for w in t), "i8", int(sizes.sum()))
    at, part = np.arange(len(x)), np.repeat(np.arange(len(texts)), sizes)
    for _ in range(4):  # fewer rounds would only leave more to do
        keep = _repeating(x[at], part)
        if keep.all():
            break
        # a part ends where a word is left out or where it ended before
        new = np.ones(len(at), bool)
        new[1:] = (part[1:] != part[:-1]) | ~keep[:-1]
        at, part = at[keep], (np.cumsum(new) - 1)[keep]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(at):
        return out
    # one value of its own, below all words, in front of each part
    cut = np.concatenate([[True], part[1:] != part[:-1]])
    place = np.arange(len(at)) + np.cumsum(cut)
    joined = np.full(len(at) + int(cut.sum()), -1, "i8")
    back = np.zeros(len(joined), "i8")
    joined[place], back[place] = x[at], at
    cuts = place[cut] - 1
    joined[cuts] = -1 - np.arange(len(cuts))
    for start, length, period in runs_of(joined).tolist():
        first = int(back[start])
        text = int(np.searchsorted(starts, first, "right")) - 1
        out[text].append((first - int(starts[text]), length, period))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run contains after its first period, one blank between."""
    kept, at = [], 0
    for start, length, period in sorted(runs, key=lambda r: r[0] + r[2]):
        if start + period > at:
            kept += words[at:start + period]
        at = max(at, start + length)
    return b" ".join(kept + words[at:]).decode()


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (by start, then period; words count from 0) and the
    collapsed text of every document.  See the module's docstring."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_slices(batches, ["doc_id", "text"]):
            words = [t.encode().split() for t in texts]  # splits at \x20 \x09-\x0D
            number = defaultdict(count().__next__)
            found = runs_of_texts([list(map(number.__getitem__, w)) for w in words])
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(map(len, words), pa.int64()),
                pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs]
                          for runs in found], pa.list_(_RUN)),
                pa.array(map(collapse, words, found), pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    return documents(docs, id_col, text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
