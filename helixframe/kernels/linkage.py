"""Agglomerative clustering with one update rule, and what is read off its merges.

A merge table has a row per merge: (left, right, distance, size). Leaves are 0 to n-1, merge k makes
cluster n+k. Ties go to the pair that comes first in the order of active clusters."""

from __future__ import annotations

import heapq

import numpy as np


def updated(method: str, one: np.ndarray, other: np.ndarray, a: float, b: float, sizes: np.ndarray, gap: float | np.ndarray) -> np.ndarray:
    """Distances to the union of two clusters of a and b members, from those to either, by Lance and
    Williams; sizes are those of the clusters on the other end, gap lies between the two. Ward's are
    squared distances."""
    if method == "average":
        return (a * one + b * other) / (a + b)
    if method == "weighted":
        return (one + other) / 2
    if method == "ward":
        return ((a + sizes) * one + (b + sizes) * other - sizes * gap) / (a + b + sizes)
    raise ValueError(method)


def agglomerated(d: np.ndarray, sizes: np.ndarray, names: list[int], method: str) -> list[tuple[int, int, float, int]]:
    """(left, right, distance, size) of all merges of clusters in this order, new ones numbered from one
    more than the largest name and put at the end. d is used up; its diagonal must be infinite."""
    out, number = [], max(names, default=-1) + 1
    names = list(names)
    for step in range(len(names) - 1):
        i, j = divmod(int(np.argmin(d)), len(d))
        i, j = min(i, j), max(i, j)
        gap = d[i, j]
        a, b = sizes[i], sizes[j]
        new = updated(method, d[i], d[j], a, b, sizes, gap)
        left, right = sorted((names[i], names[j]))
        out.append((left, right, float(gap), int(a + b)))
        keep = np.array([k for k in range(len(d)) if k not in (i, j)], int)
        shrunk = np.full((len(keep) + 1, len(keep) + 1), np.inf)
        shrunk[:-1, :-1] = d[np.ix_(keep, keep)]
        shrunk[-1, :-1] = shrunk[:-1, -1] = new[keep]
        d, sizes = shrunk, np.append(sizes[keep], a + b)
        names = [names[k] for k in keep] + [number + step]
    return out


def linkage(distances: np.ndarray, method: str = "average") -> np.ndarray:
    """Merges for 'average', 'weighted' or 'ward' (on plain distances), by Lance and Williams."""
    d = np.array(distances, float)
    d = d**2 if method == "ward" else d
    np.fill_diagonal(d, np.inf)
    out = np.array(agglomerated(d, np.ones(len(d)), list(range(len(d))), method), float).reshape(-1, 4)
    if method == "ward":
        out[:, 2] = np.sqrt(np.maximum(out[:, 2], 0))
    return out


def numbered(merges: list[tuple[int, int, float, int]], n: int) -> tuple[list[tuple[int, int, float, int]], dict[int, int]]:
    """Merges of a tree in the order in which the nearest pair goes first (of equally near ones, that of
    the lower numbers), and the number of each node. Merges name nodes by anything that leaves 0 to
    n - 1 don't; merge k makes the node n + k of the list that was given."""
    over: dict[int, int] = {}
    for k, (left, right, _, _) in enumerate(merges):
        over[left] = over[right] = k
    number = {i: i for i in range(n)}
    heap: list[tuple[float, int, int, int]] = []

    def ready(k: int) -> None:
        left, right, distance, _ = merges[k]
        if left in number and right in number:
            low, high = sorted((number[left], number[right]))
            heapq.heappush(heap, (distance, low, high, k))

    for k, (left, right, _, _) in enumerate(merges):
        if left < n and right < n:
            ready(k)
    out = []
    while heap:
        distance, low, high, k = heapq.heappop(heap)
        number[n + k] = n + len(out)
        out.append((low, high, distance, merges[k][3]))
        if (above := over.get(n + k)) is not None:
            ready(above)
    return out, number


def members(merges: np.ndarray, n: int) -> list[frozenset[int]]:
    """Leaves under each node, leaves first."""
    sets = [frozenset([i]) for i in range(n)]
    for left, right, _, _ in merges:
        sets.append(sets[int(left)] | sets[int(right)])
    return sets


def cut(merges: np.ndarray, n: int, clusters: int) -> list[int]:
    """A cluster number from 1 for each leaf, at most `clusters` of them, in order of first leaves."""
    sets = members(merges[: max(0, n - clusters)], n)
    label: dict[int, frozenset[int]] = {}
    for s in sets:  # later sets are larger
        for leaf in s:
            label[leaf] = s
    order: dict[frozenset[int], int] = {}
    return [order.setdefault(label[i], len(order) + 1) for i in range(n)]


def newick(merges: np.ndarray, labels: list[str]) -> str:
    """The tree with branch lengths from differences of height (half the merge distance)."""
    if not labels:
        return ";"
    text, height = list(labels), [0.0] * len(labels)
    for left, right, distance, _ in merges:
        a, b, top = int(left), int(right), distance / 2
        text.append(f"({text[a]}:{max(top - height[a], 0):.6f},{text[b]}:{max(top - height[b], 0):.6f})")
        height.append(top)
    return text[-1] + ";"


def splits(merges: np.ndarray, n: int) -> set[tuple[int, ...]]:
    """Non-trivial bipartitions, named by the side without leaf 0."""
    everything = frozenset(range(n))
    sides = ((everything - s if 0 in s else s) for s in members(merges, n)[n:])
    return {tuple(sorted(s)) for s in sides if 1 < len(s) < n - 1}


def last_merges(merges: np.ndarray, p: int = 30) -> list[tuple[int, int, float, int]]:
    """What a dendrogram cut to its last p merges shows."""
    return [(int(a), int(b), float(d), int(s)) for a, b, d, s in merges[-p:]]
