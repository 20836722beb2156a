"""Suffix arrays by Lyndon grouping.

First the suffixes are grouped by their longest Lyndon prefix. Groups begin as the symbols and are
visited from the largest down. The members of a group look left for the nearest suffix of a smaller
group, over previous-smaller pointers; whoever is found is now known to be followed by the group's
prefix, once or several times, and moves to a group of its own just above its old one. Then the order
is emitted from the smallest suffix up: each placed suffix places the suffixes that end where it
begins. Nothing is renamed and there is no recursion."""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Suffixes of ``text`` in order; a suffix that is a prefix of another comes first."""
    n = len(text) + 1
    low = min(text, default=0) - 1
    s = [*text, low]  # the end is smaller than all
    order = sorted(range(n), key=s.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    start = 0
    for i, suffix in enumerate(order):
        if s[suffix] != s[order[start]]:
            start = i
        place[suffix], group[suffix] = i, start
        size[start] += 1
    before = [-1] * n
    end = n - 1
    while end >= 0:
        begin = group[order[end]]
        times: dict[int, int] = {}
        for suffix in sorted(order[begin : end + 1]):
            p = suffix - 1
            while p >= 0 and group[p] >= begin:
                p = before[p]
            before[suffix] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        by_times: dict[int, list[int]] = {}
        for p, k in times.items():
            by_times.setdefault(k, []).append(p)
        for k in sorted(by_times, reverse=True):
            moved = by_times[k]
            for p in moved:
                g = group[p]
                size[g] -= 1
                to, at = g + size[g], place[p]
                other = order[to]
                order[to], order[at] = p, other
                place[p], place[other] = to, at
            for p in moved:
                group[p] += size[group[p]]
            for p in moved:
                size[group[p]] = 0
            for p in moved:
                size[group[p]] += 1
        end = begin - 1
    placed, free = [False] * n, group  # the first free place of a group is kept at its number
    next_free = list(range(n))
    order[0], placed[n - 1] = n - 1, True
    for i in range(n):
        p = order[i] - 1
        while p >= 0 and not placed[p]:
            g = free[p]
            order[next_free[g]] = p
            next_free[g] += 1
            placed[p] = True
            p = before[p]
    return order[1:]


def common_prefixes(text: list[int], order: list[int]) -> list[int]:
    """For each place of the suffix array, the symbols its suffix shares with the one before."""
    n = len(text)
    rank = [0] * n
    for i, suffix in enumerate(order):
        rank[suffix] = i
    out, h = [0] * n, 0
    for i in range(n):
        if rank[i]:
            j = order[rank[i] - 1]
            while i + h < n and j + h < n and text[i + h] == text[j + h]:
                h += 1
            out[rank[i]] = h
            h = max(0, h - 1)
        else:
            h = 0
    return out
