"""Suffix arrays by induced sorting.

Suffixes are classed as L (larger than the next one) or S (smaller). The leftmost-S (LMS) substrings are
sorted by one induction and named; the text of names is sorted in turn by the same steps, level by level,
until all names differ; an induction from the sorted LMS suffixes then gives each level's array. Every
suffix enters its place once per induction, and a level is at most half as long as the one above, so the
work is linear.

Bytes fall into few large buckets, so the first level's inductions move whole buckets in numpy (a bucket
takes as many array operations as its longest run of one symbol). Names fall into very many small buckets:
the levels below induce one suffix at a time.
"""

from __future__ import annotations

import numpy as np


def _is_s(text: np.ndarray) -> np.ndarray:
    """Which suffixes are S; ``text`` ends with its only, smallest symbol."""
    n = len(text)
    step = text[1:].astype(np.int32) - text[:-1].astype(np.int32)
    at = np.where(step != 0, np.arange(n - 1, dtype=np.int32), np.int32(n))
    following = np.minimum.accumulate(at[::-1])[::-1]  # the next place where the symbol changes
    out = np.ones(n, bool)
    out[:-1] = step[following] > 0
    return out


def _place(found: np.ndarray, symbols: np.ndarray, edge: np.ndarray, array: np.ndarray, k: int, down: bool) -> None:
    """Append suffixes to the edge of their symbols' buckets, in the order given."""
    if not len(found):
        return
    order = np.argsort(symbols, kind="stable")
    count = np.bincount(symbols, minlength=k)
    rank = np.arange(len(found)) - np.repeat(np.cumsum(count) - count, count)
    base = np.repeat(edge, count)
    array[base - 1 - rank if down else base + rank] = found[order]
    if down:
        edge -= count
    else:
        edge += count


def _induce(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """The suffix array that follows from LMS suffixes in order."""
    n = len(text)
    array = np.zeros(n, np.int32)
    array[0] = n - 1
    count = np.bincount(text, minlength=k)
    ends = np.cumsum(count)
    starts = ends - count
    l_ends = starts + np.bincount(text[~is_s], minlength=k)
    bounds = np.searchsorted(text[lms], np.arange(k + 1))
    head = starts.copy()

    def before(batch: np.ndarray, want_s: bool) -> None:
        p = batch[batch > 0] - 1
        p = p[is_s[p] == want_s]
        _place(p, text[p], tail if want_s else head, array, k, want_s)

    for c in range(k):
        done = starts[c]
        while done < head[c]:
            done, batch = head[c], array[done : head[c]]
            before(batch, False)
        if bounds[c] < bounds[c + 1]:
            before(lms[bounds[c] : bounds[c + 1]], False)
    tail = ends.copy()
    for c in range(k - 1, 0, -1):
        done = ends[c]
        while tail[c] < done:
            done, batch = tail[c], array[tail[c] : done][::-1]
            before(batch, True)
        if starts[c] < l_ends[c]:
            before(array[starts[c] : l_ends[c]][::-1], True)
    return array


def _induce_names(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """As :func:`_induce`, one suffix at a time. 0 stands for a free place: nothing comes before suffix 0."""
    n = len(text)
    count = np.bincount(text, minlength=k)
    ends = np.cumsum(count)
    array = np.zeros(n, np.int64)
    mine = np.bincount(text[lms], minlength=k)
    first = np.cumsum(mine) - mine
    array[np.repeat(ends - mine - first, mine) + np.arange(len(lms))] = lms
    places = array.tolist()
    # the symbol before each suffix, if the suffix there is to be induced (L, then S); else -1
    before = np.concatenate([[-1], text[:-1]])
    s_before = np.concatenate([[False], is_s[:-1]])
    wanted = np.where(s_before, -1, before).tolist()
    edge = (ends - count).tolist()
    for p in places:  # sees what the loop itself puts further on
        c = wanted[p]
        if c >= 0:
            places[edge[c]] = p - 1
            edge[c] += 1
    wanted = np.where(s_before, before, -1).tolist()
    edge = ends.tolist()
    for p in reversed(places):
        c = wanted[p]
        if c >= 0:
            edge[c] -= 1
            places[edge[c]] = p - 1
    return np.array(places, np.int32)


def suffix_array(text: np.ndarray, k: int, induce=_induce) -> np.ndarray:
    """Suffixes of ``text`` (symbols 0 to k - 1, 0 only at the end) in order."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int32)
    is_s = _is_s(text)
    mark = is_s.copy()
    mark[0] = False
    mark[1:] &= ~is_s[:-1]
    lms = np.flatnonzero(mark).astype(np.int32)
    rough = induce(text, is_s, lms[np.argsort(text[lms], kind="stable")], k)
    order = rough[mark[rough]]
    # name the LMS substrings: neighbours in order are equal if length and symbols are
    length = np.zeros(n, np.int32)
    length[lms[:-1]] = np.diff(lms)
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    live = np.flatnonzero(same)
    at = 0
    while len(live):
        equal = text[np.minimum(a[live] + at, n - 1)] == text[np.minimum(b[live] + at, n - 1)]
        same[live[~equal]] = False
        live = live[equal & (length[a[live]] > at)]
        at += 1
    name = np.concatenate([[0], np.cumsum(~same)])
    names = np.empty(n, np.int32)
    names[order] = name
    if name[-1] + 1 < len(order):
        order = lms[suffix_array(names[lms], int(name[-1]) + 1, _induce_names)]
    return induce(text, is_s, order, k)


def common_prefixes(raw: np.ndarray, array: np.ndarray, starts: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: for each place, the bytes it shares with its predecessor in the array
    (exact up to ``most``, and within a stretch that begins at one of ``starts``).

    Where a place and its predecessor both move on by one, the common prefix is one shorter; only the other
    (irreducible) places are compared, eight bytes at a time."""
    n = len(array)
    phi = np.zeros(n, np.int64)
    phi[array[1:]] = array[:-1]
    reducible = np.zeros(n, bool)
    reducible[1:] = (phi[1:] == phi[:-1] + 1) & (raw[: n - 1] == raw[np.minimum(phi[:-1], n - 1)][: n - 1])
    reducible[starts] = False
    reducible[array[0]] = False
    at = np.flatnonzero(~reducible)
    padded = np.concatenate([raw, np.zeros(16, np.uint8)])
    words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    shared = np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    x, y = at, phi[at]
    while len(live):
        i, j = x[live] + shared[live], y[live] + shared[live]
        inside = np.maximum(i, j) + 8 <= n
        diff = words[np.minimum(i, n)] ^ words[np.minimum(j, n)]
        equal = (diff == 0) & inside & (shared[live] < most)
        low = diff & (~diff + np.uint64(1))
        bytes_equal = np.where(diff == 0, 8, np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64) // 8)
        bytes_equal = np.minimum(bytes_equal, np.maximum(n - np.maximum(i, j), 0))
        shared[live] += np.where(equal, 8, bytes_equal)
        live = live[equal]
    out = np.zeros(n, np.int64)
    out[at] = shared
    last = np.maximum.accumulate(np.where(reducible, 0, np.arange(n)))
    return np.maximum(out[last] - (np.arange(n) - last), 0)


def repeated(stretches: list[bytes], length: int) -> list[np.ndarray]:
    """For each stretch, the starts of its ``length``-byte strings that also start elsewhere in any."""
    sizes = np.array([len(s) for s in stretches])
    raw = np.frombuffer(b"\0".join(stretches) + b"\0", np.uint8)
    ends = np.cumsum(sizes + 1) - 1  # of the separators
    starts = ends - sizes
    text = np.empty(len(raw) + 1, np.uint16)
    text[:-1] = raw
    text[:-1] += 2
    text[ends] = 1
    text[-1] = 0
    array = suffix_array(text, 258)
    array = array[array < len(raw)]
    shared = common_prefixes(raw, array, starts, int(sizes.max()) + length)
    rest = np.repeat(ends, sizes + 1) - np.arange(len(raw))  # bytes up to the separator
    before = np.zeros(len(raw), np.int64)
    before[array[1:]] = array[:-1]
    shared = np.minimum(np.minimum(shared, rest), rest[before])
    shared[array[0]] = 0
    hit = shared >= length
    hit[before[hit]] = True
    found = np.flatnonzero(hit)
    which = np.searchsorted(ends, found)
    parts = np.split(found - starts[which], np.searchsorted(which, np.arange(1, len(stretches))))
    return parts
