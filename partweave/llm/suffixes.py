"""Suffix arrays by induced sorting, and permuted common prefixes, of one shard.

``suffix_array`` classifies suffixes as smaller or larger than their successor,
sorts the substrings between leftmost smaller ones by induction, names them,
recurses on the names while any repeat, and induces the whole order from theirs:
linear in the shard's length. The two induction scans are plain loops; all that
stands around them works on whole arrays."""

from __future__ import annotations

import numpy as np

SEPARATOR = 0


def _induce(text: np.ndarray, smaller: np.ndarray, size: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The order of all suffixes (or of all substrings up to the next leftmost smaller one), given that of ``lms``."""
    n, tail = len(text), np.cumsum(size)
    head = (tail - size).tolist()
    sa = np.full(n, -1, np.int64)
    of = text[lms]
    if len(lms):
        last = np.append(np.flatnonzero(np.diff(of)) + 1, len(lms))
        runs = np.diff(last, prepend=0)
        sa[np.arange(len(lms)) + np.repeat(tail[of[last - 1]] - last, runs)] = lms
    sa = sa.tolist()
    # The symbol before a suffix if that one is larger (or smaller) than its successor, else -1; the last entry serves empty slots.
    before = np.full(n + 1, -1, np.int64)
    before[1:n] = np.where(smaller[: n - 1], -1, text[: n - 1])
    last = int(text[n - 1])
    sa[head[last]] = n - 1
    head[last] += 1
    symbols = before.tolist()
    for j in sa:
        c = symbols[j]
        if c >= 0:
            p = head[c]
            sa[p] = j - 1
            head[c] = p + 1
    before[1:n] = np.where(smaller[: n - 1], text[: n - 1], -1)
    symbols, tail = before.tolist(), tail.tolist()
    for j in reversed(sa):
        c = symbols[j]
        if c >= 0:
            p = tail[c] - 1
            sa[p] = j - 1
            tail[c] = p
    return np.array(sa, np.int64)


def _names(text: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Names of substrings ``text[at:end + 1]`` in sorted order: equal ones share a name. One that ends with the text is like no other."""
    same = np.zeros(len(at), bool)
    here = np.flatnonzero((end[1:] - at[1:] == end[:-1] - at[:-1]) & (end[1:] < len(text)) & (end[:-1] < len(text))) + 1
    step = 0
    while len(here):
        here = here[text[at[here] + step] == text[at[here - 1] + step]]
        done = at[here] + step == end[here]
        same[here[done]] = True
        here, step = here[~done], step + 1
    return np.cumsum(~same) - 1


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Starts of the suffixes of ``text`` (integers below ``symbols``) in lexicographic order; a prefix comes first."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    rise = np.append(np.sign(text[1:] - text[:-1]), -1)
    told = np.flatnonzero(rise)
    smaller = rise[told[np.searchsorted(told, np.arange(n))]] > 0
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    size = np.bincount(text, minlength=symbols)
    if not len(lms):
        return _induce(text, smaller, size, lms)
    order = _induce(text, smaller, size, lms[np.argsort(text[lms], kind="stable")])
    number = np.full(n, -1, np.int64)
    number[lms] = np.arange(len(lms))
    order = number[order]
    order = order[order >= 0]
    names = _names(text, lms[order], np.append(lms[1:], n)[order])
    if names[-1] + 1 < len(lms):
        reduced = np.empty(len(lms), np.int64)
        reduced[order] = names
        order = suffix_array(reduced, int(names[-1]) + 1)
    return _induce(text, smaller, size, lms[order])


def common_prefixes(text: np.ndarray, order: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For each position, how many symbols its suffix shares with the one before it in ``order``,
    at most ``left`` (the symbols before the next separator). Only positions whose predecessors
    differ are compared, eight symbols at a time; each other one has one symbol less than its left neighbour."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    here = np.arange(n)
    fresh = (here == 0) | (before < 1)
    fresh |= text[here - 1] != text[np.maximum(before - 1, 0)]
    fresh |= text[here - 1] == SEPARATOR
    bytes_ = np.append(text, np.zeros(8, text.dtype)).astype(np.uint64)
    words = bytes_[:n].copy()
    for k in range(1, 8):
        words |= bytes_[k : n + k] << np.uint64(8 * k)
    at = np.flatnonzero(fresh & (before >= 0))
    shared = np.zeros(n, np.int64)
    length = np.zeros(len(at), np.int64)
    most = np.minimum(left[at], left[before[at]])
    live = np.flatnonzero(length < most)
    while len(live):
        p, q = at[live] + length[live], before[at[live]] + length[live]
        apart = words[p] ^ words[q]
        low = apart & (~apart + np.uint64(1))
        same = np.where(apart == 0, 8, np.bitwise_count(low - np.uint64(1)) >> 3)
        length[live] += same
        live = live[(same == 8) & (length[live] < most[live])]
    shared[at] = np.minimum(length, most)
    source = np.maximum.accumulate(np.where(fresh, here, 0))
    return np.maximum(shared[source] - (here - source), 0)
