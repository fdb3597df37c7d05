"""Suffix arrays by linear grouping: Lyndon-prefix groups in descending order, then each group's order."""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Starts of the suffixes of a sequence of integers in ascending order; a shorter prefix comes first.

    First phase: suffixes are grouped by first symbol, and groups are taken from the highest to the
    lowest. Each member points to the nearest earlier suffix in a lower group, its previous smaller
    suffix, over higher ones by their own pointers. The suffixes pointed to move to new groups
    directly above their old one, the higher the more members point to them: their known prefix,
    a Lyndon word, has grown by that many copies of the group's. In the end a group is the suffixes
    with one longest Lyndon prefix.

    Second phase: once a suffix has its place, the suffixes whose Lyndon prefix ends where it starts
    follow in their groups in that order; the pointers list them. Nothing is renamed or sorted anew.
    """
    n = len(symbols)
    group = list(symbols)
    names = sorted(set(group))
    number = {name: i for i, name in enumerate(names)}
    group = [number[x] for x in group]
    members: list[list[int]] = [[] for _ in names]
    for i, g in enumerate(group):
        members[g].append(i)
    length = [1] * len(names)
    above = [*range(1, len(names)), -1] if names else []
    below = list(range(-1, len(names) - 1))
    previous = [-1] * n
    done = bytearray(n)
    descending: list[int] = []
    top = len(names) - 1
    while top >= 0:
        own = sorted(i for i in members[top] if group[i] == top)
        members[top] = own
        pointed: dict[int, int] = {}
        for i in own:
            done[i] = 1
            j = i - 1
            while j >= 0 and done[j]:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        by_old: dict[int, dict[int, list[int]]] = {}
        for j, times in pointed.items():
            by_old.setdefault(group[j], {}).setdefault(times, []).append(j)
        for old, by_times in by_old.items():
            lower = old
            for times in sorted(by_times):
                new = len(members)
                moved = by_times[times]
                members.append(moved)
                length.append(length[old] + times * length[top])
                for j in moved:
                    group[j] = new
                upper = above[lower]
                above.append(upper)
                below.append(lower)
                above[lower] = new
                if upper >= 0:
                    below[upper] = new
                lower = new
        if own:
            descending.append(top)
        top = below[top]

    free = [0] * len(members)
    start = 0
    for g in reversed(descending):
        free[g] = start
        start += len(members[g])
    order = [0] * n
    s, at = n, -1
    while True:
        p = s - 1
        while p >= 0 and p + length[group[p]] == s:
            g = group[p]
            order[free[g]] = p
            free[g] += 1
            p = previous[p]
        at += 1
        if at == n:
            return order
        s = order[at]
