"""Suffix sorting by prefix hashes, on numpy arrays.

One array of prefix polynomial hashes makes the hash of any substring a
difference of two entries.  Two suffixes are compared by a binary search for
the length of their common extension (a logarithmic number of hash
comparisons) and the byte behind it; a bottom-up mergesort, in which every
element finds its place in the other run by binary search, sorts all groups of
suffixes at once.  Hash equality is confirmed byte by byte where it decides a
result.
"""

from __future__ import annotations

import numpy as np

from kestrel.llm.text import mix

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2**64."""
    if len(_tables[0]) <= n:
        for t, b in ((0, _BASE), (1, _INVERSE)):
            p = np.full(n + 1, b, dtype=np.uint64)
            p[0] = 1
            _tables[t] = np.cumprod(p, dtype=np.uint64)
    return _tables[0], _tables[1]


class PrefixHashes:
    """Hashes of the substrings of a buffer."""

    def __init__(self, buf: np.ndarray):
        self.buf = buf
        power, self.inverse = _powers(len(buf))
        self.h = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[:len(buf)], dtype=np.uint64, out=self.h[1:])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.h[start + length] - self.h[start]) * self.inverse[start]

    def sliding(self, length: int) -> np.ndarray:
        """Hash of every substring of ``length`` bytes."""
        n = len(self.buf) - length + 1
        return (self.h[length:] - self.h[:n]) * self.inverse[:n]

    def common(self, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
        """Length of the common extension of suffixes at ``a`` and ``b``, up to
        ``limit`` bytes (both must have so many)."""
        found = np.zeros(len(a), np.int64)
        step = 1 << (limit.bit_length() - 1)
        while step:
            ok = found + step <= limit
            s = np.where(ok, step, 0)
            same = ok & (self.of(a + found, s) == self.of(b + found, s))
            found += np.where(same, step, 0)
            step >>= 1
        return found

    def less(self, a: np.ndarray, b: np.ndarray, whole: np.ndarray, limit: int, or_equal: np.ndarray) -> np.ndarray:
        """suffix a < suffix b (or equal, where asked), compared over ``limit``
        bytes; ``whole`` holds the hash of ``limit`` bytes per position."""
        out = or_equal.copy()
        i = np.flatnonzero(whole[a] != whole[b])
        if len(i):
            x, y = a[i], b[i]
            k = np.minimum(self.common(x, y, limit), limit - 1)
            out[i] = self.buf[x + k] < self.buf[y + k]
        return out


def same_bytes(buf: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """Whether buf[a:a+length] equals buf[b:b+length], by comparing the bytes."""
    out = np.ones(len(a), bool)
    for lo in range(0, len(a), step):
        n = length[lo:lo + step]
        if not n.sum():
            continue
        first = np.cumsum(n) - n
        k = np.arange(int(n.sum())) - np.repeat(first, n)
        differ = buf[np.repeat(a[lo:lo + step], n) + k] != buf[np.repeat(b[lo:lo + step], n) + k]
        some = np.flatnonzero(n)
        out[lo + some] = ~np.logical_or.reduceat(differ, first[some])
    return out


def sort_suffixes(hashes: PrefixHashes, start: np.ndarray, group: np.ndarray, limit: int) -> np.ndarray:
    """Order that sorts the suffixes at ``start`` inside each ``group`` (given
    in ascending order) by their first ``limit`` >= 8 bytes: by the first eight
    bytes as a number, then by mergesort among those that agree in them."""
    n = len(start)
    if n < 2:
        return np.arange(n)
    whole = hashes.sliding(limit)
    eight = np.ndarray((len(hashes.buf) - 7,), ">u8", np.ascontiguousarray(hashes.buf), strides=(1,))[start]
    order = np.lexsort((eight, group))
    changed = (group[order][1:] != group[order][:-1]) | (eight[order][1:] != eight[order][:-1])
    head = np.flatnonzero(np.concatenate(([True], changed)))
    size = np.diff(np.concatenate((head, [n])))
    first, count = np.repeat(head, size), np.repeat(size, size)
    place = np.arange(n)
    width = 1
    while width < size.max():
        at = place[count > width]                     # groups that are not yet sorted
        rank = at - first[at]
        run = rank // width
        left = run % 2 == 0
        other = np.where(left, run + 1, run - 1) * width
        some = other < count[at]                      # the other run exists
        at, rank, left, other = at[some], rank[some], left[some], other[some]
        base = first[at] + other
        lo = np.zeros(len(at), np.int64)
        hi = np.minimum(width, count[at] - other)
        mine = start[order[at]]
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            theirs = start[order[base[open_] + mid]]
            # equal suffixes keep their order: the left run's come first
            before = hashes.less(theirs, mine[open_], whole, limit, ~left[open_])
            lo[open_] = np.where(before, mid + 1, lo[open_])
            hi[open_] = np.where(before, hi[open_], mid)
        pair = rank // (2 * width) * (2 * width)
        target = first[at] + pair + (rank % width) + lo
        moved = order.copy()
        moved[target] = order[at]
        order = moved
        width *= 2
    return order


def equal_groups(hashes: PrefixHashes, start: np.ndarray, group: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """For sorted suffixes: number of the run of equal ones (same group, same
    ``limit`` bytes, confirmed) that each sorted place belongs to."""
    a, b = start[order[:-1]], start[order[1:]]
    same = (group[order[1:]] == group[order[:-1]]) & (hashes.of(a, limit) == hashes.of(b, limit))
    i = np.flatnonzero(same)
    same[i] = same_bytes(hashes.buf, a[i], b[i], np.full(len(i), limit))
    return np.concatenate(([0], np.cumsum(~same)))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbouring values."""
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def segments(buf: np.ndarray, off: np.ndarray, window: int, gram: int,
             hashes: PrefixHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cut texts into runs of neighbouring windows with the same smallest gram
    hash (their anchor): (anchor, start byte, number of windows, document).

    A window's anchor depends on its bytes only, so equal windows have equal
    anchors wherever they stand."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(buf) < window:
        return none
    anchor = sliding_minimum(mix(hashes.sliding(gram)), window - gram + 1)
    n = len(anchor)
    crossing = np.zeros(len(buf) + 1, np.int64)       # windows that reach into the next text
    ends = off[1:-1]
    np.add.at(crossing, np.maximum(ends - window + 1, 0), 1)
    np.add.at(crossing, ends, -1)
    valid = np.cumsum(crossing)[:n] == 0
    cut = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])))
    start = np.flatnonzero(cut)
    size = np.diff(np.concatenate((start, [n])))
    ok = valid[start]
    start, size = start[ok], size[ok]
    return anchor[start], start, size, np.searchsorted(off, start, side="right") - 1
