"""Progressive alignment along a guide tree."""

from __future__ import annotations

from collections import Counter

from helixframe.kernels.align import global_alignment

GAP = "-"


def consensus(rows: list[str]) -> str:
    """The most frequent letter of each column, the first row's on ties; a gap if there is none."""
    out = []
    for column in zip(*rows, strict=True):
        seen = Counter(c for c in column if c != GAP)
        out.append(max(seen, key=seen.get) if seen else GAP)
    return "".join(out)


def widen(rows: list[str], pattern: str) -> list[str]:
    """rows with a gap column wherever the pattern has a gap."""
    places, at = [], 0
    for c in pattern:
        places.append(-1 if c == GAP else at)
        at += c != GAP
    return ["".join(GAP if p < 0 else row[p] for p in places) for row in rows]


def merge_profiles(a: list[str], b: list[str]) -> list[str]:
    """Two groups of aligned rows as one, by aligning what they agree on. Columns that hold gaps
    only have no letter in the consensus and are dropped before."""
    a, b = (["".join(c) for c in zip(*[col for col in zip(*g, strict=True) if any(x != GAP for x in col)], strict=True)] or [""] * len(g) for g in (a, b))
    left, right = global_alignment(consensus(a), consensus(b))
    return widen(a, left) + widen(b, right)


def progressive(seqs: list[str], merges) -> list[str]:
    """The aligned rows, in the order of seqs."""
    if any(GAP in s for s in seqs):
        raise ValueError("sequences to be aligned must not hold gaps")
    groups = {i: ([i], [s]) for i, s in enumerate(seqs)}
    for step, (left, right, _, _) in enumerate(merges):
        (ids_a, rows_a), (ids_b, rows_b) = groups.pop(int(left)), groups.pop(int(right))
        groups[len(seqs) + step] = (ids_a + ids_b, merge_profiles(rows_a, rows_b))
    if not groups:
        return []
    ids, rows = groups.popitem()[1]
    return [row for _, row in sorted(zip(ids, rows, strict=True))]
