"""Rolling hashes and content-chosen anchors over units (bytes or words), vectorised.

An anchor of a window of ``length`` units is the start of its ``k``-gram with
the smallest hash.  Equal windows have their anchor at the same offset, so
two equal windows share its k-gram (the *seed*); neighbouring windows mostly
share the anchor itself, so there are far fewer anchors than windows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_M = np.uint64(0x9E3779B97F4A7C15)
_STEP = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
POS_BITS = np.uint64(24)
POS_MASK = np.uint64((1 << 24) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole number."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


BYTE_HASH = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _M)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def rolling(units: np.ndarray, k: int, family: int = 0) -> np.ndarray:
    """Polynomial hash of each run of ``k`` units (element i: units i to i + k - 1), by doubling."""
    if len(units) < k:
        return np.empty(0, dtype=np.uint64)
    base = _STEP[family]
    out, done, run, size = None, 0, units, 1
    while True:
        if k & size:
            if out is None:
                out = run
            else:
                n = len(units) - (done + size) + 1
                out = out[:n] * power(base, size) + run[done : done + n]
            done += size
        if done == k:
            break
        n = len(run) - size
        run = run[:n] * power(base, size) + run[size:]
        size *= 2
    return mix(out[: len(units) - k + 1])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    size, m = 1, x
    while size * 2 <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    n = len(x) - w + 1
    return np.minimum(m[:n], m[w - size : w - size + n])


@dataclass
class Anchors:
    """For each anchor: row of its document, its place, first and last window it is the anchor of (places in the block), its seed."""

    row: np.ndarray
    place: np.ndarray
    first: np.ndarray
    last: np.ndarray
    seed: np.ndarray


def anchors(units: np.ndarray, starts: np.ndarray, lengths: np.ndarray, length: int, k: int) -> Anchors:
    """Anchors of all windows that lie inside a document."""
    most = 1 << 23
    if len(units) <= 2 * most:
        return _anchors(units, starts, lengths, length, k)
    parts = []  # very long documents in runs of windows
    for row in np.flatnonzero(lengths >= length):
        for s in range(0, int(lengths[row]) - length + 1, most):
            base = int(starts[row]) + s
            n = min(int(lengths[row]) - s, most + length - 1)
            a = _anchors(units[base : base + n], np.array([0]), np.array([n]), length, k)
            parts.append(Anchors(a.row + row, a.place + base, a.first + base, a.last + base, a.seed))
    fields = ("row", "place", "first", "last", "seed")
    return Anchors(*[np.concatenate([getattr(a, f) for a in parts]) for f in fields]) if parts else _anchors(units[:0], starts, lengths * 0, length, k)


def _anchors(units: np.ndarray, starts: np.ndarray, lengths: np.ndarray, length: int, k: int) -> Anchors:
    """The same for at most 2**24 units."""
    rows = np.flatnonzero(lengths >= length)
    if not len(rows):
        e = np.empty(0, dtype=np.int64)
        return Anchors(e, e, e, e, np.empty(0, dtype=np.uint64))
    grams = rolling(units, k)
    ranked = (grams & ~POS_MASK) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_min(ranked, length - k + 1) & POS_MASK
    counts = lengths[rows] - length + 1
    ends = np.cumsum(counts)
    window = np.arange(ends[-1]) + np.repeat(starts[rows] - (ends - counts), counts)
    row = np.repeat(rows, counts)
    place = least[window].astype(np.int64)
    change = np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])])
    at = np.flatnonzero(change)
    until = np.concatenate([at[1:], [len(place)]]) - 1
    return Anchors(row[at], place[at], window[at], window[until], grams[place[at]])


def word_units(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of a byte block: starts, ends and a 64-bit hash of each (the block's documents are parted by white space)."""
    solid = np.concatenate([[False], ~IS_SPACE[raw], [False]])
    change = np.flatnonzero(solid[1:] != solid[:-1])
    begin, end = change[::2], change[1::2]
    if not len(begin):
        e = np.empty(0, dtype=np.int64)
        return e, e, np.empty(0, dtype=np.uint64)
    # sum of byte hashes times powers of the place in the word
    n = end - begin
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    longest = int(n.max())
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(longest, _STEP[1], dtype=np.uint64)]))
    values = BYTE_HASH[raw[solid[1:-1]]] * powers[within]
    sums = np.add.reduceat(values, np.cumsum(n) - n)
    return begin, end, mix(sums + n.astype(np.uint64) * _M)


def blocks(lengths: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of documents of about ``most`` units in all."""
    out, start, total = [], 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            out.append((start, i))
            start, total = i, 0
        total += int(n)
    if start < len(lengths):
        out.append((start, len(lengths)))
    return out
