"""Suffix sorting by grouping: Lyndon prefixes first, then each group's order."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> list[int]:
    """Starts of all suffixes in their order, in linear space and without recursive renaming.

    The last symbol must be smaller than all others and occur once. Groups begin as suffixes with
    the same first symbol. From the highest group down, every suffix of a group gets a pointer to
    the nearest earlier position that is in a lower group; the positions pointed at are those whose
    own prefix goes on with this group's. They leave their group for a new one right behind it,
    those pointed at most often last. In the end a group holds the suffixes with one Lyndon prefix.
    From the lowest suffix up, each then puts the suffixes that lead to it at the next free place
    of their groups.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ranked = np.asarray(symbols)[order]
    first_of = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    sizes = np.diff(np.append(first_of, n))
    group_array = np.empty(n, np.int64)
    group_array[order] = np.repeat(first_of, sizes)
    place_array = np.empty(n, np.int64)
    place_array[order] = np.arange(n)
    size_array = np.zeros(n + 1, np.int64)
    size_array[first_of] = sizes
    at, group, place, size = (a.tolist() for a in (order, group_array, place_array, size_array))

    before = [-1] * n
    end = n - 1
    while end > 0:
        first = group[at[end]]
        if first == end:
            # a group of one: its parent, if any, is a new group of one
            s = at[end]
            p = s - 1
            while p >= 0 and group[p] >= first:
                p = before[p]
            before[s] = p
            if p >= 0:
                g = group[p]
                left = size[g] - 1
                if left:
                    i, j = place[p], g + left
                    q = at[j]
                    at[i], at[j] = q, p
                    place[q], place[p] = i, j
                    size[g] = left
                    group[p] = j
                    size[j] = 1
            end -= 1
            continue
        pointed: dict[int, int] = {}
        for s in sorted(at[first : end + 1]):
            p = s - 1
            while p >= 0 and group[p] >= first:
                p = before[p]
            before[s] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        by_times: dict[int, list[int]] = {}
        for p, times in pointed.items():
            by_times.setdefault(times, []).append(p)
        for times in sorted(by_times, reverse=True):
            left_by: dict[int, int] = {}
            parents = by_times[times]
            for p in parents:
                g = group[p]
                left = size[g] - 1
                size[g] = left
                i, j = place[p], g + left
                q = at[j]
                at[i], at[j] = q, p
                place[q], place[p] = i, j
                left_by[g] = left_by.get(g, 0) + 1
            for p in parents:
                g = group[p]
                if g in left_by:
                    group[p] = g + size[g]
            for g, moved in left_by.items():
                size[g + size[g]] = moved
        end = first - 1

    out = [0] * n
    free = list(range(n))
    placed = bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        p = out[i] - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            out[free[g]] = p
            free[g] += 1
            placed[p] = 1
            p = before[p]
    return out
