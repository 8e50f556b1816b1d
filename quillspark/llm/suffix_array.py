"""Suffix arrays by induced sorting, and permuted common prefixes, as array operations.

Suffixes are S (smaller than their right neighbour) or L; an S suffix after an L one is leftmost-smaller. Sorting those decides all others: going up
through the buckets of first symbols places the L suffixes, going down the S suffixes. One bucket is a few array operations, repeated once per repeat of
its symbol. The leftmost-smaller suffixes are sorted by their substrings; while equal substrings are left, the string of their names is sorted in turn.
"""

from __future__ import annotations

import numpy as np


def smaller_than_next(s: np.ndarray) -> np.ndarray:
    """True for S suffixes; equal symbols have the type of what follows, and the end is smaller than anything."""
    n = len(s)
    kind = np.zeros(n, dtype=bool)
    differs = np.append(s[:-1] != s[1:], True)
    up = np.append(s[:-1] < s[1:], False)
    following = np.where(differs, np.arange(n), n)
    following = np.minimum.accumulate(following[::-1])[::-1]
    kind[:] = up[following]
    return kind


def dealt(rows: np.ndarray, symbols: np.ndarray, waiting: list[list[np.ndarray]]) -> None:
    """Append ``rows`` to the lists of their symbols, in their order."""
    if len(rows) == 1:
        waiting[symbols[0]].append(rows)
        return
    order = np.argsort(symbols, kind="stable")
    rows, symbols = rows[order], symbols[order]
    cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    ends = np.append(cuts, len(rows)).tolist()
    for a, b in zip([0, *cuts.tolist()], ends):
        waiting[symbols[a]].append(rows[a:b])


def induced(s: np.ndarray, kind: np.ndarray, seeds: np.ndarray, sigma: int) -> np.ndarray:
    """All suffixes in order, given the leftmost-smaller ones in order."""
    none = np.zeros(0, dtype=np.int64)
    seeds_of: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    if len(seeds):
        dealt(seeds, s[seeds], seeds_of)
    waiting: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    waiting[s[-1]].append(np.array([len(s) - 1]))
    large: list[np.ndarray] = [none] * sigma
    for c in range(sigma):
        waves = []
        while waiting[c]:
            wave = np.concatenate(waiting[c]) if len(waiting[c]) > 1 else waiting[c][0]
            waiting[c] = []
            waves.append(wave)
            before = wave[wave > 0] - 1
            before = before[~kind[before]]
            if len(before):
                dealt(before, s[before], waiting)
        if waves:
            large[c] = np.concatenate(waves)
        if seeds_of[c]:
            before = np.concatenate(seeds_of[c])
            before = before[before > 0] - 1
            if len(before):
                dealt(before, s[before], waiting)
    small: list[np.ndarray] = [none] * sigma
    waiting = [[] for _ in range(sigma)]
    for c in range(sigma - 1, -1, -1):
        waves = []
        while waiting[c]:
            wave = np.concatenate(waiting[c]) if len(waiting[c]) > 1 else waiting[c][0]
            waiting[c] = []
            waves.append(wave)
            before = wave[wave > 0] - 1
            before = before[kind[before]]
            if len(before):
                dealt(before, s[before], waiting)
        if waves:
            small[c] = np.concatenate(waves)[::-1]
        if len(large[c]):
            before = large[c][::-1]
            before = before[before > 0] - 1
            before = before[kind[before]]
            if len(before):
                dealt(before, s[before], waiting)
    return np.concatenate([part for c in range(sigma) for part in (large[c], small[c])])


def names_of(s: np.ndarray, at: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """A name for each leftmost-smaller substring, by text position: equal ones share it, and names follow the order."""
    length = np.append(np.diff(at), len(s) - at[-1]) + 1
    size = np.zeros(len(s), dtype=np.int64)
    size[at] = length
    a, b = ordered[:-1], ordered[1:]
    same = size[a] == size[b]
    same &= (a + size[a] <= len(s)) & (b + size[b] <= len(s))
    open_ = np.flatnonzero(same)
    step = 0
    while len(open_):
        equal = s[a[open_] + step] == s[b[open_] + step]
        same[open_[~equal]] = False
        open_ = open_[equal]
        step += 1
        open_ = open_[size[a[open_]] > step]
    name = np.zeros(len(s), dtype=np.int64)
    name[ordered] = np.concatenate([[0], np.cumsum(~same)])
    return name[at]


def sorted_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names: equal ones are named again by what follows, over twice the distance each time."""
    order = np.argsort(names, kind="stable")
    rank = np.empty(len(names), dtype=np.int64)
    ordered = names[order]
    head = np.append(True, ordered[1:] != ordered[:-1])
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(len(names)), 0))
    step = 1
    while True:
        size = np.bincount(rank, minlength=len(names))
        tied = np.flatnonzero(size[rank] > 1)
        if not len(tied):
            break
        follow = np.where(tied + step < len(names), rank[np.minimum(tied + step, len(names) - 1)], -1)
        place = np.lexsort((follow, rank[tied]))
        tied, follow = tied[place], follow[place]
        own = rank[tied]
        group = np.append(True, own[1:] != own[:-1])
        fresh = group.copy()
        fresh[1:] |= follow[1:] != follow[:-1]
        index = np.arange(len(tied))
        start = np.maximum.accumulate(np.where(group, index, 0))
        rank[tied] = own + np.maximum.accumulate(np.where(fresh, index, 0)) - start
        step *= 2
    result = np.empty(len(names), dtype=np.int64)
    result[rank] = np.arange(len(names))
    return result


def suffix_array(s: np.ndarray, sigma: int) -> np.ndarray:
    """Start positions of the suffixes of ``s`` (values below ``sigma``) in order."""
    if len(s) == 0:
        return np.zeros(0, dtype=np.int64)
    kind = smaller_than_next(s)
    leftmost = np.flatnonzero(kind[1:] & ~kind[:-1]) + 1
    if not len(leftmost):
        return induced(s, kind, leftmost, sigma)
    chosen = np.zeros(len(s), dtype=bool)
    chosen[leftmost] = True
    rough = induced(s, kind, leftmost, sigma)
    names = names_of(s, leftmost, rough[chosen[rough]])
    return induced(s, kind, leftmost[sorted_names(names)], sigma)


def common_prefixes(s: np.ndarray, order: np.ndarray, stop: int = -1) -> np.ndarray:
    """By text position, the length that a suffix shares with its predecessor in order, up to the next ``stop`` symbol.

    Where the symbol before differs from the predecessor's or is a ``stop``, the length is counted; elsewhere it is one less than at the position before.
    """
    n = len(s)
    if n < 2:
        return np.zeros(n, dtype=np.int64)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    counted = before < 0
    inner = np.flatnonzero((at > 0) & (before > 0))
    counted[inner] = (s[inner - 1] != s[before[inner] - 1]) | (s[inner - 1] == stop)
    counted[(at == 0) | (before == 0)] = True
    k = np.flatnonzero(counted & (before >= 0))
    length = np.zeros(n, dtype=np.int64)
    padded = np.concatenate([s, np.full(64, -1, dtype=np.int32)]).astype(np.int32)
    window = np.lib.stride_tricks.sliding_window_view(padded, 32)
    open_, step = k, 0
    while len(open_):
        kept = []
        for part in np.array_split(open_, max(1, len(open_) // 65536)):
            last = len(window) - 1
            x, y = window[np.minimum(part + step, last)], window[np.minimum(before[part] + step, last)]
            differs = (x != y) | (x < 0) | (x == stop)
            first = np.where(differs.any(axis=1), differs.argmax(axis=1), 32)
            length[part] += first
            kept.append(part[first == 32])
        open_, step = np.concatenate(kept), step + 32
    reach = np.where(counted, length + at, 0)
    result = np.maximum.accumulate(reach) - at
    result[before < 0] = 0
    return np.maximum(result, 0)
