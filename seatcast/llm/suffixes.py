"""Numpy kernels of the repeated-substring operator.

``size`` is the length of a string that counts as repeated (100 bytes), ``GRAM``
the length of an anchor.
"""

from __future__ import annotations

import numpy as np

from .shingles import mix

GRAM = 32
# Longest stretch handled at once; its places fit the low bits of a sort key.
STRETCH = 1 << 22
_PLACE_BITS = 24
_PLACE_MASK = np.uint64((1 << _PLACE_BITS) - 1)

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUE = mix(np.arange(256, dtype="u8") + np.uint64(7777)) | np.uint64(1)
_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_tables.get(base, ())) < n:
        steps = np.full(2 * n + 1, base, "u8")
        steps[0] = 1
        _tables[base] = np.cumprod(steps)
    return _tables[base]


def prefix_hashes(raw: np.ndarray) -> np.ndarray:
    """h[k]: polynomial hash of the first k bytes, low powers first, mod 2**64."""
    out = np.zeros(len(raw) + 1, "u8")
    np.cumsum(_VALUE[raw] * _powers(_BASE, len(raw))[:len(raw)], out=out[1:])
    return out


def substring_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from ``start`` up to ``end``, wherever they stand."""
    shift = _powers(_INVERSE, len(prefix))[start]
    return mix((prefix[end] - prefix[start]) * shift)


def anchor_runs(text: bytes, size: int) -> np.ndarray:
    """Rows (gram, region, anchor, left, right) as u8 and i8 bits.

    Every string of ``size`` bytes is assigned to its anchor: of the grams
    inside it, the one with the smallest hash (rightmost on ties).  That depends
    on the string alone, so equal strings have equal grams at equal distance.
    Neighbouring strings mostly share their anchor; a row covers such a run:
    ``left`` and ``right`` are the distances from the run's first and last start
    to the anchor, ``region`` hashes all its bytes and both distances.
    """
    raw = np.frombuffer(text, "u1")
    out = [np.zeros((0, 5), "i8")]
    for base in range(0, max(len(raw) - size + 1, 0), STRETCH):
        part = raw[base:base + STRETCH + size - 1]
        prefix = prefix_hashes(part)
        at = np.arange(len(part) - GRAM + 1)
        gram = substring_hashes(prefix, at, at + GRAM)
        key = (gram & ~_PLACE_MASK) | (_PLACE_MASK - at.astype("u8"))
        span, reach = size - GRAM + 1, 1
        low = key
        while 2 * reach <= span:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        rest = span - reach
        if rest:
            low = np.minimum(low[:-rest], low[rest:])
        anchor = (_PLACE_MASK - (low & _PLACE_MASK)).astype("i8")
        cut = np.flatnonzero(anchor[1:] != anchor[:-1])
        first = np.concatenate([[0], cut + 1])
        last = np.concatenate([cut, [len(anchor) - 1]])
        a = anchor[first]
        left, right = a - first, a - last
        region = substring_hashes(prefix, first, last + size)
        region = mix(region ^ mix((left * 128 + right).astype("u8")))
        out.append(np.stack([gram[a].view("i8"), region.view("i8"), base + a, left, right], 1))
    return np.concatenate(out)


def _extensions(chars: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes of every row of ``chars`` (n x width, u2)."""
    n, width = chars.shape
    value = mix(chars.astype("u8") + np.uint64(991)) * _powers(_BASE, width)[:width]
    out = np.zeros((n, width + 1), "u8")
    np.cumsum(value, axis=1, out=out[:, 1:])
    return out


def common_extension(prefix: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Longest common prefix of rows i and j by binary search on the hashes."""
    low = np.zeros(len(i), "i8")
    high = np.full(len(i), prefix.shape[1] - 1, "i8")
    while (open_ := low < high).any():
        mid = (low + high + 1) // 2
        same = prefix[i, mid] == prefix[j, mid]
        low = np.where(open_ & same, mid, low)
        high = np.where(open_ & ~same, mid - 1, high)
    return low


def suffix_sort(group: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by (group, chars), and for each place in that order the
    common prefix with the one before (-1 across groups).

    A bottom-up mergesort: in every pass each element finds its place in the
    sibling run by binary search, all elements at once.  A comparison finds the
    common extension on prefix hashes and looks at the next character.  At the
    end the neighbours' extensions are verified on the characters; should a
    hash have lied, the rows are sorted by their characters instead.
    """
    n, width = chars.shape
    prefix = _extensions(chars)
    padded = np.concatenate([chars, np.zeros((n, 1), "u2")], axis=1)

    def less(i: np.ndarray, j: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        k = common_extension(prefix, i, j)
        a, b = padded[i, k], padded[j, k]
        same = group[i] == group[j]
        inner = np.where(k == width, or_equal, a < b)
        return np.where(same, inner, group[i] < group[j])

    order = np.arange(n)
    run = 1
    at = np.arange(n)
    while run < n:
        block = at // run
        sibling = (block ^ 1) * run
        low = np.minimum(sibling, n)
        high = np.minimum(sibling + run, n)
        base = low.copy()
        is_left = block % 2 == 0
        # elements of the left run go before equal ones of the right run
        while (todo := np.flatnonzero(low < high)).size:
            mid = (low[todo] + high[todo]) // 2
            before = less(order[mid], order[todo], ~is_left[todo])
            low[todo] = np.where(before, mid + 1, low[todo])
            high[todo] = np.where(before, high[todo], mid)
        start = np.where(is_left, at - at % run, sibling)
        place = start + at % run + (low - base)
        new = np.empty(n, "i8")
        new[place] = order
        order = new
        run *= 2
    shared = np.full(n, -1, "i8")
    if n > 1:
        i, j = order[:-1], order[1:]
        k = common_extension(prefix, i, j)
        differ = chars[i] != chars[j]
        true = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        if (true != k).any():
            order = np.lexsort([*chars.T[::-1], group])
            i, j = order[:-1], order[1:]
            differ = chars[i] != chars[j]
            true = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        shared[1:] = np.where(group[i] == group[j], true, -1)
    return order, shared


def repeated_windows(group: np.ndarray, left: np.ndarray, right: np.ndarray,
                     before: np.ndarray, after: np.ndarray, size: int) -> np.ndarray:
    """(member, distance) of the strings that an earlier member has too.

    Members come in the order of their places within a group; ``before`` holds
    the bytes before the anchor, nearest first, ``after`` those from it on.  A
    string at distance o from the anchor is o bytes of the one and size - o of
    the other, so it is known by its runs in two suffix orders.
    """
    n = len(group)
    hit: list[np.ndarray] = [np.zeros((0, 2), "i8")]
    order_a, shared_a = suffix_sort(group, after)
    order_b, shared_b = suffix_sort(group, before)
    cls_a, cls_b = np.empty(n, "i8"), np.empty(n, "i8")
    for o in range(int(left.max()) + 1 if n else 0):
        cls_a[order_a] = np.cumsum(shared_a < size - o)
        cls_b[order_b] = np.cumsum(shared_b < o)
        live = np.flatnonzero((right <= o) & (o <= left))
        if len(live) < 2:
            continue
        _, first = np.unique(cls_a[live] * (n + 1) + cls_b[live], return_index=True)
        if len(first) < len(live):
            again = np.ones(len(live), bool)
            again[first] = False
            who = live[again]
            hit.append(np.stack([who, np.full(len(who), o)], 1))
    return np.concatenate(hit)


def merge_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open spans."""
    if not len(start):
        return start, end
    by = np.argsort(start, kind="stable")
    start, end = start[by], np.maximum.accumulate(end[by])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    head = np.flatnonzero(new)
    return start[head], end[np.append(head[1:] - 1, len(start) - 1)]
