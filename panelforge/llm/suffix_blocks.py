"""Sorting of suffix blocks by a difference cover, in numpy.

A block is a set of pieces of text, laid end to end at multiples of ``V``. The ranks of the cover's positions (those
whose place modulo ``V`` is in ``COVER``) are computed first, by doubling, to a depth of ``DEPTH`` bytes or more.
Suffixes are then sorted bucket by bucket: by their bucket and first ``V`` bytes, and ties by ranks at the step, below
``V``, that takes both suffixes to a cover position. Suffixes of one residue are sorted by one such rank; residues are
merged by counting, for each suffix, the smaller ones of every other residue.
"""

from __future__ import annotations

import numpy as np

#: A perfect difference cover; every difference modulo 13 is one of two of its members.
V, COVER = 13, (0, 1, 3, 9)
DEPTH = 400


def step_table() -> np.ndarray:
    """Least step after which residues a and b are both in the cover."""
    inside = np.isin(np.arange(2 * V) % V, COVER)
    return np.array([[next(s for s in range(V) if inside[a + s] and inside[b + s]) for b in range(V)] for a in range(V)])


STEP = step_table()


def _words(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First 8 and next 5 bytes at each place, as numbers that sort like the bytes."""
    view = np.lib.stride_tricks.sliding_window_view(text, 8)
    first = view[at].copy().view(">u8").reshape(-1).astype(np.uint64)
    second = view[at + 8].copy().view(">u8").reshape(-1).astype(np.uint64) >> np.uint64(24)
    return first, second


def _dense(order: np.ndarray, changed: np.ndarray) -> np.ndarray:
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(changed)
    return out


def cover_ranks(text: np.ndarray, size: int) -> np.ndarray:
    """Rank (from 1) of each cover position of ``text[:size]`` by its next ``DEPTH`` bytes; 0 elsewhere."""
    places = np.flatnonzero(np.isin(np.arange(size) % V, COVER))
    first, second = _words(text, places)
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    rank = _dense(order, np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    spread = np.zeros(len(text), dtype=np.int64)
    depth = V
    while depth < DEPTH:
        spread[places] = rank
        after = spread[np.minimum(places + depth, len(text) - 1)]
        key = rank * (len(places) + 1) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = _dense(order, np.r_[True, key[1:] != key[:-1]])
        depth *= 2
    spread[places] = rank
    return spread


def sort_block(text: np.ndarray, size: int, starts: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Order of ``starts`` by bucket, then by their next ``DEPTH`` bytes at least. Only tied ones need ranks."""
    first, second = _words(text, starts)
    order = np.lexsort((second, first, bucket))
    f, s, k = first[order], second[order], bucket[order]
    changed = np.r_[True, (f[1:] != f[:-1]) | (s[1:] != s[:-1]) | (k[1:] != k[:-1])]
    group = np.cumsum(changed) - 1
    tied = np.bincount(group)[group] > 1
    if not tied.any():
        return order
    rank = cover_ranks(text, size)
    span = int(rank.max()) + 1
    at, gid = starts[order[tied]], group[tied]
    residue = at % V
    lists = []
    for a in range(V):
        own = np.flatnonzero(residue == a)
        key = gid[own] * span + rank[at[own] + STEP[a, a]]
        lists.append(own[np.argsort(key, kind="stable")])
    smaller = np.zeros(len(at), dtype=np.int64)
    for a in range(V):
        mine = lists[a]
        for b in range(V):
            theirs = lists[b]
            if not len(mine) or not len(theirs):
                continue
            step = STEP[a, b]
            mine_key = gid[mine] * span + rank[at[mine] + step]
            their_key = gid[theirs] * span + rank[at[theirs] + step]
            smaller[mine] += np.searchsorted(their_key, mine_key, side="left")
    # ``smaller`` counts over all groups before too, so it sorts groups and their members at once
    inner = np.argsort(smaller, kind="stable")
    out = order.copy()
    out[np.flatnonzero(tied)] = order[tied][inner]
    return out


def equal_runs(text: np.ndarray, starts: np.ndarray, bucket: np.ndarray, length: int) -> np.ndarray:
    """For starts in sorted order: whether each agrees with the one before it, in bucket and ``length`` bytes."""
    same = np.r_[False, bucket[1:] == bucket[:-1]]
    live = np.flatnonzero(same)
    view = np.lib.stride_tricks.sliding_window_view(text, 8)
    steps = [*range(0, length - 7, 8)] + ([length - 8] if length % 8 else [])
    for at in steps:
        if not len(live):
            break
        a = view[starts[live] + at].copy().view("<u8").reshape(-1)
        b = view[starts[live - 1] + at].copy().view("<u8").reshape(-1)
        differ = a != b
        same[live[differ]] = False
        live = live[~differ]
    return same
