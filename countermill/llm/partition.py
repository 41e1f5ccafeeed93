"""Karmarkar-Karp differencing for many windows, on a bounded list of sizes."""

from __future__ import annotations

import heapq

import numpy as np


def _flatten(node, out: list[int]) -> None:
    stack = [node]
    while stack:
        at = stack.pop()
        if isinstance(at, tuple):
            stack.extend(at)
        else:
            out.append(at)


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Positions of ``sizes`` for each window, with near-equal sums.

    A partial partition is its non-empty windows, largest first, as sums above the smallest
    window. The two partitions of largest spread are merged, the largest windows of one on
    the smallest of the other, until one is left.
    """
    heap = [(-size, at, [(size, at)]) for at, size in enumerate(sizes)]
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        over = len(a) + len(b) - windows
        if over > 0:
            # position i of a meets position windows - 1 - i of b
            first = len(a) - over
            met = [(a[first + i][0] + b[len(b) - 1 - i][0], (a[first + i][1], b[len(b) - 1 - i][1])) for i in range(over)]
            a, b = a[:first] + met, b[: len(b) - over]
            merged = sorted(a + b, key=lambda x: -x[0])
            least = merged[-1][0]
            merged = [(s - least, t) for s, t in merged] if len(merged) == windows else merged
        else:
            merged = list(heapq.merge(a, b, key=lambda x: -x[0]))
        spread = merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)
        heapq.heappush(heap, (-spread, count, merged))
        count += 1
    out: list[list[int]] = []
    for _, _, slots in heap:
        for _, tree in slots:
            members: list[int] = []
            _flatten(tree, members)
            out.append(sorted(members))
    return out


def fill_windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """As ``differencing``, with as many windows as the capacity needs: the count starts at
    the total over the capacity and rises while a window is too full."""
    if not sizes:
        return []
    windows = max(1, -(-sum(sizes) // capacity))
    at = np.array(sizes)
    while True:
        found = differencing(sizes, windows)
        if max(int(at[members].sum()) for members in found) <= capacity:
            return found
        windows += max(1, windows // 200)
