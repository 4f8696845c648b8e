"""Suffix array by induced sorting and permuted common prefixes, on NumPy arrays.

The induction scans go bucket by bucket: what a bucket's suffixes induce is
appended to later buckets in bulk, in order.  Reduced strings with a large
alphabet are induced suffix by suffix.
"""

from __future__ import annotations

import numpy as np

#: Alphabets up to this size are induced bucket by bucket.
_SMALL = 1024


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (the last suffix is not)."""
    n = len(t)
    out = np.zeros(n, bool)
    change = np.flatnonzero(t[:-1] != t[1:])
    if len(change):
        upto = change[-1] + 1
        nxt = change[np.searchsorted(change, np.arange(upto))]
        out[:upto] = t[nxt] < t[nxt + 1]
    return out


def _bulk(t, small, lms, k):
    """Induced order of all suffixes from leftmost-smaller ones in the given order (bucket-wise)."""
    n = len(t)
    counts = np.bincount(t, minlength=k)
    start = np.concatenate([[0], np.cumsum(counts)[:-1]])
    larger = np.bincount(t[~small], minlength=k)
    sa = np.full(n, -1, np.int64)
    head, tail = start.copy(), start + counts

    def spread(j):
        ch = t[j]
        order = np.argsort(ch, kind="stable")
        j, ch = j[order], ch[order]
        c = np.bincount(ch, minlength=k)
        return j, ch, c, np.arange(len(j)) - np.repeat(np.cumsum(c)[c > 0] - c[c > 0], c[c > 0])

    def forward(j):
        if len(j):
            j, ch, c, at = spread(j)
            sa[head[ch] + at] = j
            head[:] += c

    def backward(j):
        if len(j):
            j, ch, c, at = spread(j)
            sa[tail[ch] - 1 - at] = j
            tail[:] -= c

    seeds_char = t[lms]
    by = np.argsort(seeds_char, kind="stable")
    seeds, cut = lms[by], np.searchsorted(seeds_char[by], np.arange(k + 1))
    forward(np.array([n - 1]))
    for c in np.flatnonzero(counts):
        p = start[c]
        while p < head[c]:
            j, p = sa[p:head[c]] - 1, head[c]
            forward(j[(j >= 0) & ~small[j]])
        forward(seeds[cut[c]:cut[c + 1]] - 1)
    for c in np.flatnonzero(counts)[::-1]:
        p = start[c] + counts[c]
        while p > tail[c]:
            j, p = sa[tail[c]:p][::-1] - 1, tail[c]
            backward(j[(j >= 0) & small[j]])
        j = sa[start[c]:start[c] + larger[c]][::-1] - 1
        backward(j[(j >= 0) & small[j]])
    return sa


def _single(t, small, lms, k):
    """The same order, suffix by suffix, for large alphabets."""
    n = len(t)
    counts = np.bincount(t, minlength=k)
    start = np.concatenate([[0], np.cumsum(counts)[:-1]])
    head, tail = start.tolist(), (start + counts).tolist()
    sa = [-1] * n
    text, is_small = t.tolist(), small.tolist()
    for i in lms[::-1].tolist():
        c = text[i]
        tail[c] -= 1
        sa[tail[c]] = i
    c = text[n - 1]
    sa[head[c]] = n - 1
    head[c] += 1
    for r in range(n):
        i = sa[r]
        if i > 0 and not is_small[i - 1]:
            c = text[i - 1]
            sa[head[c]] = i - 1
            head[c] += 1
    tail = (start + counts).tolist()
    for r in range(n - 1, -1, -1):
        i = sa[r]
        if i > 0 and is_small[i - 1]:
            c = text[i - 1]
            tail[c] -= 1
            sa[tail[c]] = i - 1
    return np.array(sa, np.int64)


def _same_substrings(t, order, length):
    """For neighbours in ``order``: whether their leftmost-smaller substrings are equal."""
    a, b = order[:-1], order[1:]
    same = length[:-1] == length[1:]
    todo, k = np.flatnonzero(same), 0
    while len(todo):
        differ = t[a[todo] + k] != t[b[todo] + k]
        same[todo[differ]] = False
        k += 1
        todo = todo[~differ & (length[todo] > k)]
    return same


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """Start positions of the suffixes of ``t`` (integers below ``k``) in lexicographic order."""
    t = np.asarray(t, np.int64)
    n = len(t)
    if n <= 1:
        return np.arange(n)
    induce = _bulk if k <= _SMALL else _single
    small = _types(t)
    is_lms = small.copy()
    is_lms[0] = False
    is_lms[1:] &= ~small[:-1]
    lms = np.flatnonzero(is_lms)
    if len(lms) == 0:
        return induce(t, small, lms, k)
    sa = induce(t, small, lms, k)
    order = sa[is_lms[sa]]                                    # sorted by leftmost-smaller substring
    if len(lms) > 1:
        size = np.zeros(n, np.int64)
        size[lms[:-1]] = np.diff(lms) + 1
        size[lms[-1]] = n - lms[-1]                           # runs into the end: equal to no other
        same = _same_substrings(t, order, size[order])
        same &= (order[:-1] != lms[-1]) & (order[1:] != lms[-1])
        name = np.zeros(n, np.int64)
        name[order] = np.concatenate([[0], np.cumsum(~same)])
        names = int(name[order[-1]]) + 1
        if names < len(lms):
            order = lms[suffix_array(name[lms], names)]
    return induce(t, small, order, k)


def permuted_lcp(buf: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position: common prefix (bytes) of its suffix with the one before it in the suffix array.

    Only irreducible values, whose left neighbours differ, are compared byte for byte (eight at a
    time); every other value is one less than that of the position before.
    """
    n = len(buf)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    pos = np.arange(n)
    reducible = (before > 0) & (pos > 0)
    reducible[reducible] = buf[pos[reducible] - 1] == buf[before[reducible] - 1]
    todo = np.flatnonzero(~reducible & (before >= 0))
    length = np.zeros(n, np.int64)
    padded = np.concatenate([buf, np.zeros(16, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded.view(np.uint8)[:8].view("<u8"), (n + 8,), (1,))
    i, j = todo.copy(), before[todo].copy()
    while len(todo):
        x = eight[np.minimum(i, n)] ^ eight[np.minimum(j, n)]
        same = np.full(len(x), 8)
        hit = x != 0
        low = x[hit] & (~x[hit] + np.uint64(1))
        same[hit] = (np.log2(low.astype(np.float64)).astype(np.int64)) >> 3
        same = np.minimum(same, n - np.maximum(i, j))         # the shorter suffix ends here
        length[todo] += same
        on = same == 8
        todo, i, j = todo[on], i[on] + 8, j[on] + 8
    known = np.where(reducible, 0, length + pos)
    return np.where(before >= 0, np.maximum.accumulate(known) - pos, 0)
