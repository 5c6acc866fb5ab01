"""A suffix array in linear time by grouping suffixes by their Lyndon prefixes.

Phase one takes groups of suffixes from the largest to the smallest. Each suffix of the group points to the nearest
suffix before it in a smaller group; suffixes so pointed to leave their groups for new ones right behind, those with
more pointers further up. Phase two puts suffixes in order: each placed suffix places the one before it, and all that
the pointers lead to, at the front of their groups. Nothing is renamed and there is no recursion.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The starts of the suffixes of an array of non-negative numbers, in lexicographic order (an end is less than any number)."""
    n = len(symbols) + 1
    if n == 1:
        return np.zeros(0, dtype=np.int64)
    text = np.append(np.asarray(symbols, dtype=np.int64) + 1, 0)
    by_symbol = np.argsort(text, kind="stable")
    ranked = text[by_symbol]
    starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    ends = np.append(starts[1:], n) - 1
    group_of = np.empty(n, dtype=np.int64)
    group_of[by_symbol] = np.repeat(starts, ends - starts + 1)
    place_of = np.empty(n, dtype=np.int64)
    place_of[by_symbol] = np.arange(n)
    # a group is known by the first place of its range
    order, place, group = by_symbol.tolist(), place_of.tolist(), group_of.tolist()
    last = [0] * n
    for a, b in zip(starts.tolist(), ends.tolist()):
        last[a] = b
    before = [-1] * n

    def promote(moved: list[int], old: int) -> None:
        """Gives suffixes of a group the upper end of its range as a group of their own."""
        top = end = last[old]
        for j in moved:
            at, other = place[j], order[end]
            order[at], order[end] = other, j
            place[other], place[j] = at, end
            end -= 1
        last[old] = end
        last[end + 1] = top
        for j in moved:
            group[j] = end + 1

    end = n - 1
    while end >= 0:
        g = group[order[end]]
        members = order[g : end + 1]
        if end > g:
            members.sort()
        pointers: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = before[j]
            before[i] = j
            if j >= 0:
                pointers[j] = pointers.get(j, 0) + 1
        if len(pointers) == 1:
            (j,) = pointers
            promote([j], group[j])
        elif pointers:
            parts: dict[tuple[int, int], list[int]] = {}
            for j, count in pointers.items():
                parts.setdefault((-count, group[j]), []).append(j)
            for _, old in sorted(parts):
                promote(parts[_, old], old)
        end = g - 1

    out, front, placed = [-1] * n, list(range(n)), bytearray(n)
    out[0], placed[n - 1] = n - 1, 1
    for at in range(n):
        j = out[at] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[front[g]] = j
            front[g] += 1
            placed[j] = 1
            j = before[j]
    return np.array(out[1:], dtype=np.int64)
