"""Suffix arrays by induced sorting and permuted common prefixes.

Suffixes are classified as smaller (S) or larger (L) than the next; the leftmost S suffixes (LMS) are sorted, recursively, by
the names of their substrings; the others are induced from them bucket by bucket. Where there are few symbols, the suffixes of a bucket
follow in whole-array waves, one for each repeat of the symbol, and each wave is one stable counting sort. The recursion's strings have
nearly as many symbols as places: there, and where a symbol repeats very often in a row, the same passes go place by place.
"""

from __future__ import annotations

import numpy as np


def _types(s: np.ndarray) -> np.ndarray:
    """True for S suffixes; the last suffix is L, since the end is smaller than any symbol."""
    n = len(s)
    change = np.flatnonzero(s[1:] != s[:-1])
    after = np.searchsorted(change, np.arange(n))
    smaller = np.zeros(n, bool)
    has = after < len(change)
    at = change[after[has]]
    smaller[has] = s[at] < s[at + 1]
    return smaller


#: A bucket's wave costs as much as so many places one by one.
WAVE_PLACES = 30


def _induce(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array from the LMS suffixes in order."""
    edges = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]]))
    waves = max(sigma, int(np.diff(edges).max()))
    return _in_waves(s, smaller, lms, sigma) if waves * WAVE_PLACES < len(s) else _by_place(s, smaller, lms, sigma)


def _by_place(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """The induced order, one place after the other: work in proportion to the string, whatever its symbols."""
    n = len(s)
    counts = np.bincount(s, minlength=sigma)
    ends = np.cumsum(counts)
    text, small = s.tolist(), smaller.tolist()
    sa = [-1] * n
    tail = ends.tolist()
    for i in reversed(lms.tolist()):
        c = text[i]
        tail[c] -= 1
        sa[tail[c]] = i
    head = (ends - counts).tolist()
    c = text[n - 1]  # induced by the end of the string, which comes first
    sa[head[c]] = n - 1
    head[c] += 1
    for k in range(n):
        j = sa[k] - 1
        if j >= 0 and not small[j]:
            c = text[j]
            sa[head[c]] = j
            head[c] += 1
    tail = ends.tolist()
    for k in range(n - 1, -1, -1):
        j = sa[k] - 1
        if j >= 0 and small[j]:
            c = text[j]
            tail[c] -= 1
            sa[tail[c]] = j
    return np.array(sa, np.int64)


def _in_waves(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    n = len(s)
    counts = np.bincount(s, minlength=sigma)
    heads = np.cumsum(counts) - counts
    n_larger = np.bincount(s[~smaller], minlength=sigma)
    sa = np.full(n, -1, np.int64)
    # L suffixes, from the smallest bucket on; each bucket's LMS suffixes come after its L suffixes
    by = np.argsort(s[lms], kind="stable")
    grouped = lms[by]
    cut = np.searchsorted(s[lms][by], np.arange(sigma + 1))
    fill = heads.copy()
    last = s[n - 1]
    sa[fill[last]] = n - 1  # induced by the end of the string
    fill[last] += 1

    def put(found: np.ndarray) -> None:
        symbols = s[found]
        order = np.argsort(symbols, kind="stable")
        found, symbols = found[order], symbols[order]
        size = np.bincount(symbols, minlength=sigma)
        start = np.cumsum(size) - size
        sa[fill[symbols] + np.arange(len(found)) - start[symbols]] = found
        fill[:] += size

    for c in np.flatnonzero(counts):
        low = heads[c]
        while low < fill[c]:
            high = fill[c]
            before = sa[low:high] - 1
            before = before[before >= 0]
            before = before[~smaller[before]]
            if len(before):
                put(before)
            low = high
        before = grouped[cut[c] : cut[c + 1]] - 1
        before = before[before >= 0]
        before = before[~smaller[before]]
        if len(before):
            put(before)
    # S suffixes, from the largest bucket down, filled from the back
    fill = heads + counts

    def put_back(found: np.ndarray) -> None:
        symbols = s[found]
        order = np.argsort(symbols, kind="stable")
        found, symbols = found[order], symbols[order]
        size = np.bincount(symbols, minlength=sigma)
        start = np.cumsum(size) - size
        sa[fill[symbols] - 1 - (np.arange(len(found)) - start[symbols])] = found
        fill[:] -= size

    for c in np.flatnonzero(counts)[::-1]:
        high = heads[c] + counts[c]
        while high > fill[c]:
            low = fill[c]
            before = sa[low:high][::-1] - 1
            before = before[before >= 0]
            before = before[smaller[before]]
            if len(before):
                put_back(before)
            high = low
        before = sa[heads[c] : heads[c] + n_larger[c]][::-1] - 1
        before = before[before >= 0]
        before = before[smaller[before]]
        if len(before):
            put_back(before)
    return sa


def suffix_array(s: np.ndarray, sigma: int = 256) -> np.ndarray:
    """Order of all suffixes of the symbols s (whole numbers from 0, below sigma)."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    smaller = _types(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(lms) < 2:
        return _induce(s, smaller, lms, sigma)
    # LMS substrings in order: induced from the LMS suffixes in any order of their first symbols
    sa = _induce(s, smaller, lms, sigma)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]
    # names: equal substrings, up to and with the next LMS symbol, get one
    end = np.empty(n, np.int64)
    end[lms] = np.append(lms[1:], n - 1)
    length = end[order] - order + 1
    differ = np.ones(len(order), bool)
    differ[1:] = length[1:] != length[:-1]
    # the last one also ends the string
    last = np.flatnonzero(order == lms[-1])[0]
    differ[last] = True
    if last + 1 < len(order):
        differ[last + 1] = True
    alike = np.flatnonzero(~differ)
    step = 0
    while len(alike):
        a, b = order[alike], order[alike - 1]
        apart = s[a + step] != s[b + step]
        differ[alike[apart]] = True
        step += 1
        alike = alike[~apart & (step < length[alike])]
    name = np.empty(n, np.int64)
    name[order] = np.cumsum(differ) - 1
    names = name[lms]
    ranked = order if differ.all() else lms[suffix_array(names, int(names.max()) + 1)]
    return _induce(s, smaller, ranked, sigma)


def permuted_lcp(s: np.ndarray, sa: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """(common prefix of each suffix with the one before it in sa, by place in the text and at most cap; that suffix, -1 for the first).

    A value is irreducible where the symbols before both suffixes differ; the others are one less than their left neighbour's.
    """
    n = len(s)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    place = np.arange(n)
    irreducible = (phi <= 0) | (place == 0)
    rest = np.flatnonzero(~irreducible)
    irreducible[rest] = s[rest - 1] != s[phi[rest] - 1]
    # also where the left neighbour's predecessor is not this one's left neighbour
    follows = np.zeros(n, bool)
    follows[1:] = phi[1:] == phi[:-1] + 1
    start = np.flatnonzero((irreducible | ~follows) & (phi >= 0))
    value = np.zeros(len(start), np.int64)
    live, step = np.arange(len(start)), 0
    while len(live) and step < 2 * cap:
        a, b = start[live] + step, phi[start[live]] + step
        inside = (a < n) & (b < n)
        live, a, b = live[inside], a[inside], b[inside]
        same = s[a] == s[b]
        live = live[same]
        step += 1
        value[live] = step
    out = np.zeros(n, np.int64)
    out[start] = value
    reach = np.full(n, -1, np.int64)
    reach[start] = start + value
    capped = np.zeros(n, bool)
    capped[start] = value >= 2 * cap
    # a run that was cut at 2 * cap goes on: its members are measured from the nearest start
    lead = np.full(n, -1, np.int64)
    lead[start] = start
    lead = np.maximum.accumulate(lead)
    follow = (lead >= 0) & (phi >= 0)
    at = place[follow]
    out[at] = np.maximum(out[lead[at]] - (at - lead[at]), 0)
    far = at[capped[lead[at]] & (out[at] < cap)]
    if len(far):
        live, step, got = np.arange(len(far)), 0, np.zeros(len(far), np.int64)
        while len(live) and step < cap:
            a, b = far[live] + step, phi[far[live]] + step
            inside = (a < n) & (b < n)
            live, a, b = live[inside], a[inside], b[inside]
            live = live[s[a] == s[b]]
            step += 1
            got[live] = step
        out[far] = got
    return np.minimum(out, cap), phi
