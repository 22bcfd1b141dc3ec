"""Suffix arrays in linear time by grouping (after Baier), without renaming or recursion."""

from __future__ import annotations

import numpy as np


def lyndon_groups(text: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """Suffixes of a sequence of small numbers grouped by their longest Lyndon prefix.

    Returns (array, group, smaller): the suffixes with each group in one stretch and the groups in
    ascending order; where the group of a suffix starts in it; and for each suffix the last one before
    it in the text that lies in a lower group (-1: none).

    Groups start as the suffixes of one first symbol and are taken in descending order. The members of a
    group follow on suffixes of lower groups, their previous smaller ones; those are moved to the upper
    end of their own group, the ones before more repeats of the taken group higher.
    """
    n = len(text)
    order = np.argsort(text, kind="stable")
    ranked = text[order]
    starts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, n))
    last_of = np.zeros(n + 1, np.int64)
    last_of[starts] = starts + sizes - 1
    first = np.empty(n, np.int64)
    first[order] = np.repeat(starts, sizes)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    array, group, where, last = order.tolist(), first.tolist(), place.tolist(), last_of.tolist()
    smaller, jump, taken = [-1] * n, [-1] * n, bytearray(n + 1)
    end = n - 1
    while end >= 0:
        start = group[array[end]]
        if start == end:
            s = array[end]
            p = s - 1
            while p >= 0 and taken[p]:
                p = jump[p]
            smaller[s] = jump[s] = p
            taken[s] = 1
            if p >= 0:
                low = group[p]
                top = last[low]
                if low != top:
                    at, other = where[p], array[top]
                    array[at], array[top] = other, p
                    where[other], where[p] = at, top
                    group[p] = last[top] = top
                    last[low] = top - 1
            end -= 1
            continue
        members = sorted(array[start : end + 1])
        repeats: dict[int, int] = {}
        for s in members:
            p = s - 1
            while p >= 0 and taken[p]:
                p = jump[p]
            if p >= 0 and group[p] == start:
                p = smaller[p]  # the same prefix once more; its own pointer is known, it lies before s
            smaller[s] = jump[s] = p
            if p >= 0:
                repeats[p] = repeats.get(p, 0) + 1
        for s in members:
            taken[s] = 1
        by_count: dict[int, list[int]] = {}
        for p, k in repeats.items():
            by_count.setdefault(k, []).append(p)
        for k in sorted(by_count, reverse=True):
            moved: dict[int, int] = {}
            for p in by_count[k]:
                low = group[p]
                gone = moved.get(low, 0)
                top = last[low] - gone
                at, other = where[p], array[top]
                array[at], array[top] = other, p
                where[other], where[p] = at, top
                moved[low] = gone + 1
            for low, gone in moved.items():
                top = last[low]
                new = top - gone + 1
                if new != low:
                    for q in array[new : top + 1]:
                        group[q] = new
                    last[new] = top
                    last[low] = new - 1
        end = start - 1
    return array, group, smaller


def suffix_array(text: np.ndarray) -> list[int]:
    """The suffixes in ascending order. A suffix follows its group's earlier ones as soon as the suffix
    behind its Lyndon prefix is known, which ends where the next smaller suffix starts."""
    n = len(text)
    _, group, smaller = lyndon_groups(text)
    out, free, placed = [-1] * n, list(range(n)), bytearray(n)
    s = n - 1  # before the empty suffix, the least of all
    for i in range(n + 1):
        while s >= 0 and not placed[s]:
            g = group[s]
            out[free[g]] = s
            free[g] += 1
            placed[s] = 1
            s = smaller[s]
        if i < n:
            s = out[i] - 1
    return out
