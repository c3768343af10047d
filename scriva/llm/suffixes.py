"""Suffix arrays by linear grouping.

Suffixes are first grouped by their longest Lyndon prefix, then every group's order is emitted; nothing is renamed or sorted
recursively. Grouping starts from the first symbols and takes the groups in descending order: each suffix of a group points to
the previous suffix of a smaller group, and the suffixes pointed at move into new groups right behind their own, those with
more pointers behind those with fewer. The order follows from the smallest suffix on: the suffix before one that is placed,
and those it points to, each take the first free place of their group.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np


def lyndon_groups(text: list[int]) -> tuple[list[int], list[int]]:
    """For each suffix of text (whose last symbol is smaller than all others): its group's first place, and its pointer."""
    n = len(text)
    slots = np.argsort(np.array(text), kind="stable").tolist()
    place = [0] * n
    head = [0] * n
    count: dict[int, int] = {}
    start = 0
    for k, i in enumerate(slots):
        if k and text[i] != text[slots[k - 1]]:
            start = k
        place[i], head[i] = k, start
        count[start] = k - start + 1
    point = [-1] * n
    done = bytearray(n)
    end = n
    while end:
        start = head[slots[end - 1]]
        found: dict[int, int] = {}
        for i in sorted(slots[start:end]):
            j = i - 1
            while j >= 0 and done[j]:
                j = point[j]
            point[i] = j
            done[i] = 1
            if j >= 0:
                found[j] = found.get(j, 0) + 1
        moves: dict[tuple[int, int], list[int]] = defaultdict(list)
        for j, times in found.items():
            moves[-times, head[j]].append(j)
        # Splitting shrinks a group but never changes where it starts, so the heads noted above stay right for those left.
        for (_, old), members in sorted(moves.items()) if len(moves) > 1 else moves.items():
            size, k = count[old], len(members)
            if k == size:
                continue
            new = old + size - k
            count[old], count[new] = size - k, k
            last = old + size - 1
            for j in members:
                p, other = place[j], slots[last]
                slots[p], slots[last] = other, j
                place[other], place[j] = p, last
                head[j] = new
                last -= 1
        end = start
    return head, point


def suffix_array(text: list[int]) -> list[int]:
    """The order of the suffixes of text, whose last symbol must be smaller than all others."""
    n = len(text)
    head, point = lyndon_groups(text)
    free: dict[int, int] = {}
    order = [-1] * n
    placed = bytearray(n)
    order[0] = n - 1
    placed[n - 1] = 1
    for k in range(n):
        j = order[k] - 1
        while j >= 0 and not placed[j]:
            group = head[j]
            at = free.get(group, group)
            order[at] = j
            free[group] = at + 1
            placed[j] = 1
            j = point[j]
    return order

