"""Pairwise alignment. Rows of the dynamic programme are computed at once: a gap in the row above is
an element-wise maximum, and runs of gaps along the row are a running maximum of scores from which
the gap line is taken off."""

from __future__ import annotations

import numpy as np

MATCH, MISMATCH, GAP = 1, -1, -2


def codes(seq: str) -> np.ndarray:
    return np.frombuffer(seq.encode("utf-32-le"), np.uint32)


def _row(previous: np.ndarray, match: np.ndarray, first: int, line: np.ndarray, gap: int) -> np.ndarray:
    best = np.maximum(previous[:-1] + match, previous[1:] + gap)
    return np.maximum.accumulate(np.concatenate(([first], best)) - line) + line


def global_score(a: str, b: str, match: int = MATCH, mismatch: int = MISMATCH, gap: int = GAP) -> int:
    """Score of the best global alignment, in two rows of memory."""
    if len(a) < len(b):
        a, b = b, a
    x, y = codes(a), codes(b)
    line = np.arange(len(y) + 1, dtype=np.int64) * gap
    row = line.copy()
    for i, c in enumerate(x, 1):
        row = _row(row, np.where(y == c, match, mismatch), i * gap, line, gap)
    return int(row[-1])


def distance(a: str, b: str) -> float | None:
    """1 minus the score a letter of the longer sequence, not under 0; None for two empty ones."""
    longest = max(len(a), len(b))
    return max(0.0, 1 - global_score(a, b) / longest) if longest else None


def global_alignment(a: str, b: str, match: int = MATCH, mismatch: int = MISMATCH, gap: int = GAP) -> tuple[str, str]:
    """Both sequences with gaps. From the end, a pair is preferred to a gap in b, that to one in a."""
    x, y = codes(a), codes(b)
    line = np.arange(len(y) + 1, dtype=np.int32) * gap
    step = np.zeros((len(x) + 1, len(y) + 1), np.uint8)  # 0 pair, 1 gap in b, 2 gap in a
    step[0, 1:], step[1:, 0] = 2, 1
    row = line.copy()
    for i, c in enumerate(x, 1):
        pair = np.where(y == c, match, mismatch)
        new = _row(row, pair, i * gap, line, gap)
        step[i, 1:] = np.where(new[1:] == row[:-1] + pair, 0, np.where(new[1:] == row[1:] + gap, 1, 2))
        row = new
    left, right, i, j = [], [], len(x), len(y)
    while i or j:
        move = step[i, j]
        left.append("-" if move == 2 else a[i - 1])
        right.append("-" if move == 1 else b[j - 1])
        i, j = i - (move != 2), j - (move != 1)
    return "".join(reversed(left)), "".join(reversed(right))


def letter_scores(letter: int, y: np.ndarray, match: int, mismatch: int, table: dict[str, dict[str, int]] | None) -> np.ndarray:
    """Scores of a letter against others: by a substitution table where it has both, else by match."""
    plain = np.where(y == letter, match, mismatch)
    for other, score in (table or {}).get(chr(letter), {}).items():
        plain[y == ord(other)] = score
    return plain


class Coded:
    """Letters of many sequences as small numbers, and the scores of each with each. A number past the
    letters fills up what is shorter than the longest; it scores like a mismatch and ends nothing early,
    as it is behind all letters."""

    def __init__(self, *lists: list[str], match: int = 2, mismatch: int = -1, table: dict[str, dict[str, int]] | None = None):
        lengths = [np.array([len(s) for s in own], np.int64) for own in lists]
        letters, numbers = np.unique(np.concatenate([codes(s) for own in lists for s in own] or [np.zeros(0, np.uint32)]), return_inverse=True)
        self.table = table is not None
        self.match, self.mismatch, self.scores = np.int32(match), np.int32(mismatch), np.full((len(letters) + 2,) * 2, mismatch, np.int32)
        for i, c in enumerate(letters if self.table else ()):
            self.scores[i, : len(letters)] = letter_scores(int(c), letters, match, mismatch, table)
        self.lists, at = [], 0
        for n, own in enumerate(lengths):
            inside = np.arange(own.max(initial=0)) < own[:, None]
            filled = np.full(inside.shape, len(letters) + n, np.int32)  # fillers of different lists differ
            filled[inside] = numbers[at : at + own.sum()]
            self.lists.append(filled)
            at += own.sum()
        self.lengths = lengths

    def against(self, letter: np.ndarray, others: np.ndarray) -> np.ndarray:
        return self.scores[letter, others] if self.table else np.where(others == letter, self.match, self.mismatch)

    def narrow(self, kind: type) -> None:
        """Scores of another width."""
        self.scores, self.match, self.mismatch = self.scores.astype(kind), kind(self.match), kind(self.mismatch)


def _words(numbers: np.ndarray, lengths: np.ndarray, k: int, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, number) of every k-mer of filled-up rows."""
    places = np.arange(max(0, numbers.shape[1] - k + 1))
    row, place = np.nonzero(places < (lengths - k + 1)[:, None])
    word = np.zeros(len(row), np.int64)
    for i in range(k):
        word = word * base + numbers[row, place + i]
    return row, place, word


def seed_diagonals(coded: Coded, k: int, seeds: int, apart: int) -> tuple[np.ndarray, np.ndarray]:
    """(pair, diagonal) of the diagonals that hold a common k-mer (seeds = 1), or two that start at most
    `apart` letters from each other (seeds = 2), be it as one longer common word."""
    base = len(coded.scores)
    if base**k >= 1 << 62:
        raise ValueError("a seed is too long for this alphabet")
    (row, i, word), (other, j, there) = (_words(x, n, k, base) for x, n in zip(coded.lists, coded.lengths, strict=True))
    _, number = np.unique(np.concatenate([word, there]), return_inverse=True)
    one, two = row * (1 + number.max(initial=0)) + number[: len(word)], other * (1 + number.max(initial=0)) + number[len(word) :]
    order = np.argsort(two, kind="stable")
    low, high = (np.searchsorted(two[order], one, side) for side in ("left", "right"))
    many = high - low
    at = np.repeat(np.arange(len(one)), many)
    met = order[np.repeat(low - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())] if len(one) else at
    widths = [x.shape[1] for x in coded.lists]
    line = row[at] * (widths[0] + widths[1] + 1) + (i[at] - j[met] + widths[1])  # a number for pair and diagonal
    if seeds > 1:
        span = widths[0] + apart + k + 1
        keys = np.sort(line * span + i[at])
        line = keys[:-1][np.diff(keys) <= apart] // span
    line = np.unique(line)
    return line // (widths[0] + widths[1] + 1), line % (widths[0] + widths[1] + 1) - widths[1]


def diagonal_scores(first: list[str], second: list[str], k: int, seeds: int, apart: int, match: int = 2, mismatch: int = -1, table: dict[str, dict[str, int]] | None = None) -> np.ndarray:
    """The best ungapped score of each pair over its diagonals with enough seeds (place in the first
    minus place in the second), all at once: sums along a diagonal less their least before."""
    best = np.zeros(len(first), np.int64)
    if not len(first):
        return best
    coded = Coded(first, second, match=match, mismatch=mismatch, table=table)
    which, diagonal = seed_diagonals(coded, k, seeds, apart)
    a, b = (np.pad(x, ((0, 0), (0, 1)), constant_values=len(coded.scores) - 2 + n) for n, x in enumerate(coded.lists))
    in_a, in_b = np.maximum(diagonal, 0), np.maximum(-diagonal, 0)
    length = np.minimum(coded.lengths[0][which] - in_a, coded.lengths[1][which] - in_b)
    order = np.argsort(length, kind="stable")
    step = max(1, (1 << 18) // max(1, int(length.max(initial=0))))
    for low in range(0, len(order), step):
        some = order[low : low + step]
        along, own = np.arange(max(0, int(length[some].max()))), which[some, None]
        left = a[own, np.minimum(in_a[some, None] + along, a.shape[1] - 1)]
        right = b[own, np.minimum(in_b[some, None] + along, b.shape[1] - 1)]
        sums = np.zeros((len(some), len(along) + 1), np.int32)
        np.cumsum(coded.against(left, right), axis=1, out=sums[:, 1:])
        np.maximum.at(best, which[some], (sums - np.minimum.accumulate(sums, axis=1)).max(axis=1))
    return best


def pair_scores(first: list[str], second: list[str], match: int = 2, mismatch: int = -1, gap_open: int = 10, gap_extend: int = 1, table: dict[str, dict[str, int]] | None = None) -> np.ndarray:
    """Scores of the best local alignments of many pairs, all at once in two rows of memory each."""
    if not len(first):
        return np.zeros(0, np.int64)
    coded = Coded(first, second, match=match, mismatch=mismatch, table=table)
    x, y = coded.lists
    # Half the width where no sum can leave it: twice the cells at once.
    most = (int(np.abs(coded.scores).max()) + gap_extend) * (min(x.shape[1], y.shape[1]) + 1) + gap_extend * y.shape[1] + gap_open
    kind = np.int16 if most < 1 << 14 else np.int32
    coded.narrow(kind)
    low, shift = kind(-(1 << 14) if kind is np.int16 else -(1 << 28)), np.arange(y.shape[1] + 1, dtype=kind) * kind(gap_extend)
    h, e = np.zeros((len(y), y.shape[1] + 1), kind), np.full(y.shape, low, kind)
    core, run, best = np.zeros_like(h), np.zeros_like(h), np.zeros(len(y), kind)
    gap_open, gap_extend = kind(gap_open), kind(gap_extend)
    for i in range(x.shape[1]):
        np.subtract(e, gap_extend, out=e)
        np.maximum(e, low, out=e)
        np.maximum(h[:, 1:] - gap_open, e, out=e)
        np.add(h[:, :-1], coded.against(x[:, i, None], y), out=core[:, 1:])
        np.maximum(core[:, 1:], e, out=core[:, 1:])
        np.maximum(core[:, 1:], 0, out=core[:, 1:])
        np.maximum(best, core.max(axis=1), out=best)  # a gap along the row never makes the best
        np.add(core, shift, out=run)
        np.maximum.accumulate(run, axis=1, out=run)
        np.subtract(run[:, :-1], shift[1:] + (gap_open - gap_extend), out=h[:, 1:])
        np.maximum(h[:, 1:], core[:, 1:], out=h[:, 1:])
    return best.astype(np.int64)


def local_scores(a: str, others: list[str], *rule, **named) -> np.ndarray:
    """Scores of the best local alignments of one sequence with many."""
    return pair_scores([a] * len(others), others, *rule, **named)


def pair_alignments(first: list[str], second: list[str], match: int = 2, mismatch: int = -1, gap_open: int = 10, gap_extend: int = 1, table: dict[str, dict[str, int]] | None = None) -> list[dict | None]:
    """Best local alignments of many pairs, filled all at once: score, identities, spans (from 1), gaps
    opened; None without a common letter.

    A row needs the gap along itself; it is a running maximum over scores shifted by the extension
    cost, since opening a gap out of a gap never helps while opening costs more than extending."""
    if not len(first):
        return []
    coded = Coded(first, second, match=match, mismatch=mismatch, table=table)
    x, y = coded.lists
    n, width = y.shape
    shift, low = np.arange(width + 1, dtype=np.int32) * gap_extend, -(1 << 28)
    h, e = np.zeros((n, width + 1), np.int32), np.full((n, width + 1), low, np.int32)
    core, f = np.zeros_like(h), np.full_like(h, low)
    trace = np.zeros((x.shape[1] + 1, n, width + 1), np.uint8)  # 1 pair, 2 gap in b, 3 gap in a; +4: e extends, +8: f extends
    best, at_i, at_j, every = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64), np.arange(n)
    for i in range(1, x.shape[1] + 1):
        opened, longer = h - gap_open, e - gap_extend
        e = np.maximum(opened, longer)
        pair = h[:, :-1] + coded.against(x[:, i - 1, None], y)
        core[:, 1:] = np.maximum(np.maximum(pair, e[:, 1:]), 0)
        run = np.maximum.accumulate(core + shift, axis=1)
        f[:, 1:] = run[:, :-1] - (gap_open - gap_extend) - shift[1:]
        new = np.maximum(core, f)
        mark = trace[i]
        mark[:, 1:] = np.where(new[:, 1:] == 0, 0, np.where(new[:, 1:] == pair, 1, np.where(new[:, 1:] == e[:, 1:], 2, 3)))
        mark += 4 * (longer > opened).astype(np.uint8)
        mark[:, 1:] += 8 * (f[:, :-1] - gap_extend > new[:, :-1] - gap_open).astype(np.uint8)
        h = new
        where = h.argmax(axis=1)
        top = h[every, where]
        more = top > best
        best[more], at_i[more], at_j[more] = top[more], i, where[more]
    return [_traced(a, b, trace[:, k], int(best[k]), int(at_i[k]), int(at_j[k])) for k, (a, b) in enumerate(zip(first, second, strict=True))]


def local_alignment(a: str, b: str, match: int = 2, mismatch: int = -1, gap_open: int = 10, gap_extend: int = 1, table: dict[str, dict[str, int]] | None = None) -> dict | None:
    """The best local alignment of a pair, as in pair_alignments."""
    return pair_alignments([a], [b], match, mismatch, gap_open, gap_extend, table)[0]


def _traced(a: str, b: str, trace: np.ndarray, best: int, last_i: int, last_j: int) -> dict | None:
    if not best:
        return None
    i, j = last_i, last_j
    same = pairs = opens = length = 0
    state = 1
    while i and j:
        mark = int(trace[i, j])
        move = mark & 3 if state == 1 else state
        if state == 1 and move == 0:
            break
        length += 1
        if move == 1:
            same += a[i - 1] == b[j - 1]
            pairs += 1
            i, j = i - 1, j - 1
        elif move == 2:
            more = mark & 4
            i -= 1
            state = 2 if more else 1
            opens += not more
        else:
            more = mark & 8
            j -= 1
            state = 3 if more else 1
            opens += not more
    return {"score": best, "identities": same, "mismatch": pairs - same, "alnlen": length, "gapopen": opens, "qstart": i + 1, "qend": last_i, "tstart": j + 1, "tend": last_j}
