"""Counts of the k-mers of many texts at once, letters being code points."""

from __future__ import annotations

import numpy as np

#: Numbers under which a row and a k-mer are one key.
_MOST = 1 << 62


def counted(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """(row, nth, kmers, n): row has kmers[nth] n times, by row; texts shorter than k have none."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    many = max(0, len(points) - k + 1)
    inside = row[:many] == row[len(points) - many :]
    if not inside.any():
        return np.zeros(0, int), np.zeros(0, int), [], np.zeros(0, int)
    seen = np.zeros(int(points.max()) + 1, bool)
    seen[points] = True
    letters = np.flatnonzero(seen)
    digits = (np.cumsum(seen) - 1)[points]
    base = bound = len(letters)
    code, tables = digits[:many], []
    for step in range(1, k):
        table = None
        if bound * base * len(texts) > _MOST:  # numbered anew, by those that occur
            table, code = np.unique(code, return_inverse=True)
            bound = len(table)
        tables.append(table)
        code, bound = code * base + digits[step : step + many], bound * base
    keys, n = np.unique(row[:many][inside] * bound + code[inside], return_counts=True)
    row, code = np.divmod(keys, bound)
    code, nth = np.unique(code, return_inverse=True)
    parts = []
    for table in reversed(tables):
        code, last = np.divmod(code, base)
        parts.append(last)
        code = code if table is None else table[code]
    text = letters[np.stack([code, *reversed(parts)], axis=1)].astype("<u4").tobytes().decode("utf-32-le")
    return row, nth, [text[i : i + k] for i in range(0, len(text), k)], n
