"""Word shingles of a text as 64-bit hashes, and HyperMinHash registers.

Everything here works on one text with numpy; tasks call it per row.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
EMPTY = 0xFFFF
BAND = 4
BANDS = BUCKETS // BAND

# Fixed odd multipliers (splitmix64 finalizer and golden-ratio increment).
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D

# Leading zeros are counted in the upper 46 of a value's 57 bits, where a float
# holds them exactly.
_TOP_BITS = 46
_LOW_BITS = 64 - BUCKET_BITS - _TOP_BITS


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype="u8")) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SHIFT = mix(np.arange(1000, 1000 + WORDS, dtype="u8")) | np.uint64(1)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(2 * n + 1, _BASE, "u8")
        steps[0] = 1
        _POWERS = np.cumprod(steps)
    return _POWERS


_POWERS = np.ones(1, "u8")


def word_hashes(raw: bytes) -> np.ndarray:
    """A hash per word of ``raw``; words are runs of bytes other than space
    and 0x09-0x0D."""
    b = np.frombuffer(raw, "u1")
    inner = ~_SPACE[b]
    edge = np.diff(inner.astype("i1"), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, "u8")
    sizes = ends - starts
    at = np.flatnonzero(inner)
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(at)) - np.repeat(first, sizes)
    parts = _BYTE[b[at]] * _powers(int(sizes.max()))[place]
    return mix(np.add.reduceat(parts, first) + sizes.astype("u8"))


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles; a text of fewer words
    has one shingle, its whole word sequence; no words, no shingle."""
    w = word_hashes(text.encode().lower())  # bytes.lower: A-Z only
    n = len(w)
    if not n:
        return w
    k = min(n, WORDS)
    total = np.full(n - k + 1, k, "u8")
    for j in range(k):
        total += (w[j:n - k + 1 + j] ^ _SHIFT[j]) * _SHIFT[k - 1 - j]
        total = mix(total)
    return np.unique(total)


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted hash set.  A hash's top bits choose
    the bucket; the bucket's smallest remaining value is kept as its count of
    leading zeros and the ten bits after the first one."""
    bounds = np.arange(BUCKETS, dtype="u8") << np.uint64(64 - BUCKET_BITS)
    first = np.searchsorted(hashes, bounds)
    out = np.full(BUCKETS, EMPTY, "u2")
    full = np.flatnonzero(first < np.append(first[1:], len(hashes)))
    if len(full):
        low = (hashes[first[full]] << np.uint64(BUCKET_BITS)) >> np.uint64(BUCKET_BITS + _LOW_BITS)
        part, power = np.frexp(low.astype("f8"))  # part in [0.5, 1), or 0
        mantissa = np.where(low > 0, (part - 0.5) * 2 * (1 << MANTISSA_BITS), 0).astype("u2")
        zeros = (_TOP_BITS - np.where(low > 0, power, 0)).astype("u2")
        out[full] = (zeros << np.uint16(MANTISSA_BITS)) | mantissa
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One key per band of four registers; bands of empty registers have none."""
    bands = sig.reshape(BANDS, BAND)
    keys = mix(np.ascontiguousarray(bands).view("u8")[:, 0]
               ^ mix(np.arange(BANDS, dtype="u8")))
    return keys[(bands != EMPTY).any(axis=1)]


def collision_rate(n_a: float, n_b: float) -> float:
    """Chance that a bucket's two different minima share a register: the
    product of both densities of a minimum, times the width of a register's
    cell, summed over the counts of leading zeros."""
    a, b = n_a / BUCKETS, n_b / BUCKETS
    z = np.arange(_TOP_BITS + 1)
    high, low = np.exp2(-z.astype("f8")), np.exp2(-(z + 1.0))
    mass = (np.exp(-(a + b) * low) - np.exp(-(a + b) * high)) * a * b / (a + b)
    return float(np.sum(mass * low / (1 << MANTISSA_BITS)))


def estimate(equal: np.ndarray, used: np.ndarray, n_a: np.ndarray,
             n_b: np.ndarray) -> np.ndarray:
    """Jaccard estimates from counts of equal and of used registers (not empty
    in both), less the equal registers that chance collisions explain."""
    chance = np.array([collision_rate(a, b) for a, b in zip(n_a, n_b, strict=True)])
    return np.clip((equal - chance * used) / np.maximum(used, 1), 0, 1)


def may_reach(equal, used, n_a, n_b, threshold: float, spread: float = 7.0) -> np.ndarray:
    """Whether the estimate lies within ``spread`` standard deviations of the
    threshold, or above; never true for sets whose sizes rule it out."""
    est = estimate(equal, used, n_a, n_b)
    slack = spread * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1))
    sizes = np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b) - 1e-9
    return sizes & (est >= threshold - slack)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on full sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)




def intersections(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``x`` with all of ``y``, by
    products of 0/1 matrices over the shingles that both sides hold."""
    flat = [np.concatenate(s) if s else np.zeros(0, "u8") for s in (x, y)]
    common = np.intersect1d(*(np.unique(f) for f in flat), assume_unique=True)
    out = np.zeros((len(x), len(y)), "f4")
    spots = []
    for sets, all_ in zip((x, y), flat, strict=True):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        col = np.searchsorted(common, all_)
        col[col == len(common)] = 0
        hit = common[col] == all_ if len(common) else np.zeros(len(all_), bool)
        by = np.argsort(col[hit], kind="stable")
        spots.append((row[hit][by], col[hit][by]))
    for at in range(0, len(common), 4096):
        part = []
        for (row, col), sets in zip(spots, (x, y), strict=True):
            lo, hi = np.searchsorted(col, [at, at + 4096])
            m = np.zeros((len(sets), min(4096, len(common) - at)), "f4")
            m[row[lo:hi], col[lo:hi] - at] = 1
            part.append(m)
        out += part[0] @ part[1].T
    return out
