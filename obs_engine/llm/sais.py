"""Suffix arrays by induced sorting, and permuted longest common prefixes.

Suffixes are classified as larger or smaller than their right neighbour; the leftmost
smaller ones (LMS) are sorted by inducing the order of their substrings, and where
substrings repeat, by sorting the string of their names recursively; then two linear
scans induce the order of all other suffixes. The scans go bucket by bucket with numpy.
A string of names has as many buckets as symbols, for which those scans would be loops in
Python (measured: 1.3 microseconds a byte of the text, five times all the rest), so the
recursion sorts names by the names of the halves: each level names runs of twice as many
LMS substrings, of the suffixes still tied.
"""

from __future__ import annotations

import numpy as np


def smaller(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last symbol is the unique smallest."""
    n = len(t)
    out = np.zeros(n, bool)
    out[-1] = True
    if n > 1:
        differs = np.flatnonzero(t[:-1] != t[1:])
        nxt = differs[np.searchsorted(differs, np.arange(n - 1))]
        out[:-1] = t[nxt] < t[nxt + 1]
    return out


def place(sa: np.ndarray, ptr: np.ndarray, items: np.ndarray, chars: np.ndarray, step: int) -> None:
    """Put items into their buckets in order: upwards from ``ptr`` or downwards before it."""
    if len(ptr) <= 1 << 16:
        chars = chars.astype(np.uint16)  # sorted by radix
    order = np.argsort(chars, kind="stable")
    c = chars[order]
    n = np.bincount(c, minlength=len(ptr))
    within = np.arange(len(c)) - np.repeat(np.cumsum(n) - n, n)
    sa[ptr[c] + within if step > 0 else ptr[c] - 1 - within] = items[order]
    ptr += step * n


def induce_buckets(t: np.ndarray, s: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array from LMS suffixes in the given order; a few buckets."""
    n = len(t)
    size = np.bincount(t, minlength=sigma)
    end = np.cumsum(size)
    begin = end - size
    sa = np.full(n, -1, np.int32)
    # LMS suffixes at their buckets' ends, in order.
    own = np.bincount(t[lms], minlength=sigma)
    place(sa, end - own, lms, t[lms], 1)
    head = begin.copy()
    for c in range(sigma):
        got, done = [], begin[c]
        while done < head[c]:
            cur = sa[done : head[c]]
            done = head[c]
            p = cur[cur > 0] - 1
            p = p[~s[p]]
            here = t[p] == c
            same = p[here]
            sa[head[c] : head[c] + len(same)] = same
            head[c] += len(same)
            got.append(p[~here])
        if own[c]:
            p = sa[end[c] - own[c] : end[c]]
            p = p[p > 0] - 1
            got.append(p[~s[p]])
        p = np.concatenate(got) if got else np.empty(0, np.int32)
        if len(p):
            place(sa, head, p, t[p], 1)
    tail = end.copy()
    for c in range(sigma - 1, -1, -1):
        got, done = [], end[c]
        while done > tail[c]:
            cur = sa[tail[c] : done][::-1]
            done = tail[c]
            p = cur[cur > 0] - 1
            p = p[s[p]]
            here = t[p] == c
            same = p[here]
            sa[tail[c] - len(same) : tail[c]] = same[::-1]
            tail[c] -= len(same)
            got.append(p[~here])
        cur = sa[begin[c] : head[c]][::-1]
        p = cur[cur > 0] - 1
        got.append(p[s[p]])
        p = np.concatenate(got)
        if len(p):
            place(sa, tail, p, t[p], -1)
    sa[0] = n - 1
    return sa


def named(t: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Name of each LMS substring (in text order): equal ones share it, names follow ``order``."""
    at = np.searchsorted(lms, order)
    length = np.append(np.diff(lms) + 1, 1)[at]
    same = length[1:] == length[:-1]
    live = np.flatnonzero(same)
    k = 0
    while len(live):
        equal = t[order[live] + k] == t[order[live + 1] + k]
        same[live[~equal]] = False
        k += 1
        live = live[equal]
        live = live[length[live] > k]
    names = np.empty(len(lms), np.int64)
    names[at] = np.concatenate(([0], np.cumsum(~same)))
    return names


def sorted_names(names: np.ndarray) -> np.ndarray:
    """Suffix array of a string of names, by naming runs of doubled length recursively."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1  # past the end
    # The rank of a suffix is where its group of equal runs begins.
    begin = np.concatenate(([True], names[order[1:]] != names[order[:-1]]))
    at = np.maximum.accumulate(np.where(begin, np.arange(n), 0))
    rank[order] = at
    k = 1
    while not begin.all():
        tied = ~begin
        tied[:-1] |= ~begin[1:]
        slots = np.flatnonzero(tied)
        items = order[slots]
        key = rank[items] * (n + 1) + rank[np.minimum(items + k, n)] + 1
        by = np.argsort(key, kind="stable")
        order[slots] = items[by]
        key = key[by]
        begin[slots[1:]] |= key[1:] != key[:-1]
        at = np.maximum.accumulate(np.where(begin, np.arange(n), 0))
        rank[order[slots]] = at[slots]
        k *= 2
    return order


def suffix_array(t: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array of ``t`` over ``sigma`` symbols, whose last symbol 0 occurs once."""
    if len(t) == 1:
        return np.zeros(1, np.int32)
    s = smaller(t)
    lms = (np.flatnonzero(s[1:] & ~s[:-1]) + 1).astype(np.int32)
    sa = induce_buckets(t, s, lms, sigma)
    is_lms = np.zeros(len(t), bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]
    names = named(t, lms, order)
    if len(names) and int(names.max()) + 1 < len(lms):
        order = lms[sorted_names(names)]
    return induce_buckets(t, s, order, sigma)


def permuted_lcp(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position, the common prefix with the suffix before it in the array.

    Where the symbols before both agree, the value is one less than that of the position
    before; only the other positions are compared.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    i = np.arange(n)
    real = before >= 0
    follows = real & (i > 0) & (before > 0)
    follows[1:] &= real[:-1]
    follows &= t[i - 1] == t[np.maximum(before, 1) - 1]
    first = np.flatnonzero(real & ~follows)
    plcp = np.zeros(n, np.int64)
    live, k = first, 0
    while len(live):
        a, b = live + k, before[live] + k
        inside = (a < n) & (b < n)
        equal = np.zeros(len(live), bool)
        equal[inside] = t[a[inside]] == t[b[inside]]
        plcp[live[equal]] += 1
        live = live[equal]
        k += 1
    last = np.maximum.accumulate(np.where(follows, 0, i))
    return np.where(follows, np.maximum(plcp[last] - (i - last), 0), plcp)
