"""Neighbour joining, parsimony and likelihood of trees."""

from __future__ import annotations

import numpy as np

STATES = 20


def neighbour_joining(distances: np.ndarray, labels: list[str]) -> str:
    """The tree as text: branch lengths of six decimals, none under zero, the last edge halved."""
    d, text = np.array(distances, float), list(labels)
    if len(text) < 2:
        return (text[0] if text else "") + ";"
    while len(text) > 2:
        k = len(text)
        sums = d.sum(axis=1)
        q = (k - 2) * d - sums[:, None] - sums[None, :]
        q[np.tril_indices(k)] = np.inf
        i, j = divmod(int(np.argmin(q)), k)
        to_i = d[i, j] / 2 + (sums[i] - sums[j]) / (2 * (k - 2))
        joined = f"({text[i]}:{max(to_i, 0):.6f},{text[j]}:{max(d[i, j] - to_i, 0):.6f})"
        new = (d[i] + d[j] - d[i, j]) / 2
        keep = [m for m in range(k) if m not in (i, j)]
        d = np.vstack([np.column_stack([d[np.ix_(keep, keep)], new[keep]]), np.append(new[keep], 0)])
        text = [text[m] for m in keep] + [joined]
    return f"({text[0]}:{d[0, 1] / 2:.6f},{text[1]}:{d[0, 1] / 2:.6f});"


def parsimony(merges: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Changes at each site: sets of states as bit masks (leaves x sites), intersected where they
    share a state, else united at the cost of one change."""
    nodes, cost = list(masks), np.zeros(masks.shape[1], np.int64)
    for left, right, _, _ in merges:
        a, b = nodes[int(left)], nodes[int(right)]
        both = a & b
        apart = both == 0
        nodes.append(np.where(apart, a | b, both))
        cost += apart
    return cost


def substitution(t: float, states: int = STATES) -> tuple[float, float]:
    """Chances of the same and of one other state after time t, all changes alike."""
    if t <= 0:
        return 1.0, 0.0
    fade = np.exp(-states * t / (states - 1))
    return float(1 / states + (states - 1) / states * fade), float(1 / states - fade / states)


def log_likelihood(merges: np.ndarray, leaves: np.ndarray, halve: bool = False, least: float = 0.001) -> np.ndarray:
    """Log-likelihood of each site by pruning; leaves holds state numbers (leaves x sites), -1 for
    a gap, which fits every state. A branch is the difference of merge distances, a leaf's the
    whole distance (with halve: of heights), `least` at least. Nodes are rescaled as they are made."""
    n, sites = leaves.shape
    part, height, scale = [], [0.0] * n, np.zeros(sites)
    for row in leaves:
        one = np.zeros((sites, STATES))
        known = row >= 0
        one[np.nonzero(known)[0], row[known]] = 1
        one[~known] = 1
        part.append(one)
    for left, right, distance, _ in merges:
        top, product = distance / 2 if halve else distance, np.ones((sites, STATES))
        for child in (int(left), int(right)):
            same, other = substitution(max(top - height[child], least))
            below = part[child]
            product *= other * below.sum(axis=1, keepdims=True) + (same - other) * below
        largest = product.max(axis=1)
        largest[largest <= 0] = 1
        scale += np.log(largest)
        part.append(product / largest[:, None])
        height.append(top)
    with np.errstate(divide="ignore"):
        return np.log(part[-1].mean(axis=1)) + scale


def sampled_sites(length: int, about: int = 200) -> range:
    return range(0, length, max(1, length // about))
