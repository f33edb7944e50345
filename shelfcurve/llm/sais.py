"""Suffix arrays by induced sorting, and permuted longest-common-prefix arrays, in numpy."""

from __future__ import annotations

import numpy as np

SMALL = 512  # alphabets up to this size are induced bucket by bucket with array operations


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it; the last one is."""
    n = len(s)
    change = np.flatnonzero(np.diff(s)) + 1  # starts of runs after the first
    rises = np.append(s[change] > s[change - 1], True)  # is a run followed by something greater
    return np.repeat(rises, np.diff(np.concatenate([[0], change, [n]])))


class _Buckets:
    def __init__(self, s: np.ndarray, k: int):
        self.end = np.cumsum(np.bincount(s, minlength=k))
        self.start = np.concatenate([[0], self.end[:-1]])


def _spread(at: np.ndarray, c: np.ndarray, pointer: np.ndarray, sa: np.ndarray, sign: int) -> None:
    """Put each of ``at`` into the bucket of its symbol, in order, from ``pointer`` on."""
    order = np.argsort(c.astype(np.uint16), kind="stable")  # symbols are below SMALL; numpy sorts short numbers by radix
    c, at = c[order], at[order]
    first = np.flatnonzero(np.diff(c, prepend=-1))
    size = np.diff(np.append(first, len(c)))
    rank = np.arange(len(c)) - np.repeat(first, size)
    sa[pointer[c] + sign * rank] = at
    pointer[c[first]] += sign * size


def _induce_small(s: np.ndarray, k: int, smaller: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The order that sorted ``seeds`` (leftmost-smaller suffixes) induce, a bucket at a time."""
    n = len(s)
    sa = np.full(n, -1, np.int64)
    b = _Buckets(s, k)
    seed_c = s[seeds]
    seed_end = np.searchsorted(seed_c, np.arange(k), "right")
    seed_start = np.searchsorted(seed_c, np.arange(k), "left")
    head = b.start.copy()
    for c in range(k):
        done = b.start[c]
        while True:  # the larger suffixes of the bucket, those that join meanwhile included
            wave = sa[done : head[c]]
            done = head[c]
            if not len(wave):
                break
            p = wave[wave > 0] - 1
            p = p[~smaller[p]]
            if len(p):
                _spread(p, s[p], head, sa, 1)
        p = seeds[seed_start[c] : seed_end[c]] - 1
        p = p[p >= 0]
        if len(p):
            _spread(p, s[p], head, sa, 1)
    tail = b.end - 1
    for c in range(k - 1, -1, -1):
        done = b.end[c] - 1
        while True:
            wave = sa[tail[c] + 1 : done + 1][::-1]
            done = tail[c]
            if not len(wave):
                break
            p = wave[wave > 0] - 1
            p = p[smaller[p]]
            if len(p):
                _spread(p, s[p], tail, sa, -1)
        wave = sa[b.start[c] : head[c]][::-1]
        p = wave[wave > 0] - 1
        p = p[smaller[p]]
        if len(p):
            _spread(p, s[p], tail, sa, -1)
    sa[0] = n - 1
    return sa


def _induce_large(s: np.ndarray, k: int, smaller: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The same one suffix at a time, for alphabets about as large as the string."""
    n = len(s)
    b = _Buckets(s, k)
    text, less = s.tolist(), smaller.tolist()
    sa = [-1] * n
    tail = (b.end - 1).tolist()
    for i in seeds[::-1].tolist():
        c = text[i]
        sa[tail[c]] = i
        tail[c] -= 1
    head = b.start.tolist()
    for i in range(n):
        j = sa[i] - 1
        if j >= 0 and not less[j]:
            c = text[j]
            sa[head[c]] = j
            head[c] += 1
    tail = (b.end - 1).tolist()
    for i in range(n - 1, -1, -1):
        j = sa[i] - 1
        if j >= 0 and less[j]:
            c = text[j]
            sa[tail[c]] = j
            tail[c] -= 1
    sa[0] = n - 1
    return np.array(sa, np.int64)


def suffix_array(s: np.ndarray, k: int) -> np.ndarray:
    """The suffix array of ``s``, numbers below ``k`` whose last is a unique least 0."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    smaller = _types(s)
    induce = _induce_small if k <= SMALL else _induce_large
    left = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1  # leftmost-smaller suffixes in text order
    if len(left) > 1:
        # sort their substrings: seeds by first symbol only, then induce
        rough = induce(s, k, smaller, left[np.argsort(s[left], kind="stable")])
        is_left = np.zeros(n, bool)
        is_left[left] = True
        ordered = rough[is_left[rough]]
        name = np.empty(n, np.int64)
        name[ordered] = np.cumsum(_differs(s, left, ordered)) - 1
        names = name[left]
        most = int(names.max()) + 1
        if most < len(left):
            place = suffix_array(names, most)
        else:
            place = np.empty(len(left), np.int64)
            place[names] = np.arange(len(left))
        left = left[place]
    return induce(s, k, smaller, left)


def _differs(s: np.ndarray, left: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Whether each of the ``ordered`` substrings differs from the one before it."""
    until = np.zeros(len(s), np.int64)
    until[left[:-1]] = left[1:] + 1
    until[left[-1]] = left[-1] + 1  # the end of the text, which no other substring has
    size = until[ordered] - ordered
    new = np.append(True, size[1:] != size[:-1])
    same = np.flatnonzero(~new)
    a, b, rest, step = ordered[same], ordered[same - 1], size[same], 0
    while len(same):  # compare symbol by symbol those that are alike so far
        unequal = s[a + step] != s[b + step]
        new[same[unequal]] = True
        step += 1
        on = ~unequal & (rest > step)
        same, a, b, rest = same[on], a[on], b[on], rest[on]
    return new


def permuted_lcp(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position the length of its common prefix with the suffix before it in ``sa``.

    Where the symbols before both are equal, the value is that of the position before less one; the
    others are compared symbol by symbol.
    """
    n = len(s)
    before = np.empty(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    at = np.arange(n)
    own = np.append(True, s[at[1:] - 1] != s[before[1:] - 1])
    own[1:] |= (before[1:] <= 0) | (before[:-1] < 0)
    i = np.flatnonzero(own & (before >= 0))
    j = before[i]
    length = np.zeros(n, np.int64)
    active, step = np.arange(len(i)), 0
    while len(active):
        inside = (i[active] + step < n) & (j[active] + step < n)
        active = active[inside]
        active = active[s[i[active] + step] == s[j[active] + step]]
        step += 1
        length[i[active]] = step
    source = np.maximum.accumulate(np.where(own, at, 0))
    return np.maximum(length[source] - (at - source), 0)
