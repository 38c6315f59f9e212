"""Embedding whitening by a one-sided Jacobi SVD.

Entries become whole numbers, so that means are exact sums: a centred entry is (n x - S) / n, a whole
number divided once, however far the numbers lie from zero. The centred rows are compressed by a
blockwise TSQR: each task folds its rows into a triangle R by QR of R and the next block, and triangles
are merged by a tree reduction whose rounds are written out, so that only one R of d x d comes to the
driver. Squares are never formed: R has the singular values and right vectors of all centred rows.

Plane rotations then make R's columns orthogonal, pair by pair (d / 2 disjoint pairs at once), until no
pair has a cosine over rounding. The lengths of the columns are the singular values, small ones as
accurate as large ones, and the accumulated rotations are the components. A whitened row is its centred
row projected on the components and divided by their standard deviations. The covariance of what comes
out is measured over all rows (means and squares merged by task, centred before multiplying), and its
largest distance from the identity is returned with them.

Cases: rows whose vector is null, or holds a null or non-finite entry, take no part; vectors of one
length are a space of their own, fitted and whitened apart; empty vectors give no row; repeated rows
count and come as often as they occur, rows with a null id as well; components without variance (fewer
rows than dimensions, constant entries, one row) have no rows; of equal eigenvalues any basis comes;
deviation is null where the exact number is beyond a long, and an entry whose whole number is beyond one
is an error; an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm._common import narrow
from helixframe.storage import release, scratch

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Rows that are folded into a triangle at once, and triangles or covariances that are merged at once.
BLOCK, FAN = 4096, 16
#: Sweeps at most, the cosine that counts as none, and the share of the largest square that is none.
_SWEEPS, _ROUNDING, _NOTHING = 60, 1e-15, 1e-60


def whole_numbers(rows: DataFrame, id_col: str, vector_col: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, width, x) of the rows that take part."""
    vectors = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")).filter("v IS NOT NULL")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.filter(~bad).select("vec_id", F.size("v").alias("width"), F.transform("v", lambda c: F.floor(c * scale) + F.lit(shift).cast("long")).alias("x"))


class Means(NamedTuple):
    """The number of rows of a length, and the exact sum of each entry."""

    n: int
    sums: np.ndarray

    def deviations(self, x: np.ndarray) -> np.ndarray:
        return self.n * x - self.sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x) / self.n


def means(numbers: DataFrame) -> dict[int, Means]:
    counts = {r.width: r.n for r in numbers.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = {width: Means(n, np.zeros(width, np.int64)) for width, n in counts.items()}
    for r in numbers.select("width", F.posexplode("x").alias("pos", "entry")).groupBy("width", "pos").agg(F.sum("entry").alias("s")).collect():
        out[r.width].sums[r.pos] = r.s
    return out


def _matrices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, places, matrix) of the vectors of each length."""
    vectors = batch.column(column)
    widths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        if width:
            yield width, at, vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), width)


def folded(triangle: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    """The triangle of what the triangle stands for and more rows."""
    return np.linalg.qr(rows if triangle is None else np.vstack([triangle, rows]), mode="r")


_STATE = pa.schema([("part", pa.int64()), ("width", pa.int32()), ("state", pa.list_(pa.float64()))])
_STATE_DDL = "part long, width int, state array<double>"


def _state_rows(part: int, states: dict[int, np.ndarray]) -> pa.RecordBatch:
    columns = [[part] * len(states), list(states), [s.ravel() for s in states.values()]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _STATE, strict=True)], schema=_STATE)


def _compressed(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triangles: dict[int, np.ndarray] = {}
        waiting: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for width, _, x in _matrices(batch, "x"):
                waiting.setdefault(width, []).append(held.value[width].centred(x))
                if sum(map(len, waiting[width])) >= BLOCK:
                    triangles[width] = folded(triangles.get(width), np.concatenate(waiting.pop(width)))
        for width, parts in waiting.items():
            triangles[width] = folded(triangles.get(width), np.concatenate(parts))
        yield _state_rows(TaskContext.get().partitionId(), triangles)

    return run


def _merging(merge: Callable[[np.ndarray | None, np.ndarray, int], np.ndarray]):
    """One state for each width and part, whose rows lie together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            for part, width, values in zip(batch.column("part").to_pylist(), batch.column("width").to_pylist(), batch.column("state"), strict=True):
                if (part, width) != key:
                    if state is not None:
                        yield _state_rows(key[0], {key[1]: state})
                    key, state = (part, width), None
                state = merge(state, values.values.to_numpy(), width)
        if state is not None:
            yield _state_rows(key[0], {key[1]: state})

    return run


def tree_reduced(states: DataFrame, merge: Callable[[np.ndarray | None, np.ndarray, int], np.ndarray], parts: int) -> dict[int, np.ndarray]:
    """The merged state of each width: neighbouring parts become one, round by round, in tasks."""
    now = scratch(states, "whiten-states")
    while True:
        parts = -(-parts // FAN)
        group = now.select(F.floor(F.col("part") / FAN).cast("long").alias("part"), "width", "state")
        after = scratch(group.repartition("part", "width").sortWithinPartitions("part", "width").mapInArrow(_merging(merge), _STATE_DDL), "whiten-states")
        release(now)
        now = after
        if parts <= 1:
            out = {r.width: np.array(r.state) for r in now.collect()}
            release(now)
            return out


def _merge_triangles(state: np.ndarray | None, values: np.ndarray, width: int) -> np.ndarray:
    return folded(state, values.reshape(-1, width))


def jacobi(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, falling, and the right vectors as columns) by one-sided rotations."""
    d = r.shape[1]
    columns, turned = np.array(r.T, float, order="C"), np.eye(d)  # as rows, which are contiguous
    nothing = _NOTHING * (columns * columns).sum(axis=1).max(initial=0)
    players = np.arange(d + d % 2)  # a tournament: each round has disjoint pairs, and all meet once a sweep
    for _ in range(_SWEEPS):
        rotated = False
        for _ in range(len(players) - 1):
            pairs = np.stack([players[: len(players) // 2], players[::-1][: len(players) // 2]])
            p, q = pairs[:, (pairs < d).all(axis=0)]
            a, b = columns[p], columns[q]
            alpha, beta, gamma = (a * a).sum(axis=1), (b * b).sum(axis=1), (a * b).sum(axis=1)
            some = (np.abs(gamma) > _ROUNDING * np.sqrt(alpha) * np.sqrt(beta)) & (np.minimum(alpha, beta) > nothing)
            if some.any():
                rotated = True
                p, q, a, b = p[some], q[some], a[some], b[some]
                zeta = (beta[some] - alpha[some]) / (2 * gamma[some])
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
                c = (1 / np.hypot(1, t))[:, None]
                s = c * t[:, None]
                columns[p], columns[q] = c * a - s * b, s * a + c * b
                a, b = turned[p], turned[q]
                turned[p], turned[q] = c * a - s * b, s * a + c * b
            players = np.concatenate([players[:1], players[-1:], players[1:-1]])
        if not rotated:
            break
    values = np.sqrt((columns * columns).sum(axis=1))
    order = np.argsort(-values, kind="stable")
    return values[order], turned[order].T


class Space(NamedTuple):
    """What whitens the vectors of a length: means, components as columns and their standard
    deviations, and the share of the variance that each explains."""

    means: Means
    components: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.means.centred(x) @ self.components / self.deviations


def fit(numbers: DataFrame, most: int = COMPONENTS) -> dict[int, Space]:
    """The space of each length of vectors, over all rows (width, x); numbers is read twice."""
    known = means(numbers)
    held = numbers.sparkSession.sparkContext.broadcast(known)
    triangles = tree_reduced(numbers.select("x").mapInArrow(_compressed(held), _STATE_DDL), _merge_triangles, numbers.rdd.getNumPartitions())
    out = {}
    for width, values in triangles.items():
        singular, vectors = jacobi(values.reshape(-1, width))
        keep = min(most, int((singular > singular[0] * width * 2.3e-16).sum())) if singular[0] > 0 else 0
        total = (singular**2).sum()
        out[width] = Space(known[width], vectors[:, :keep], singular[:keep] / np.sqrt(known[width].n), singular[:keep] ** 2 / total if keep else np.zeros(0))
    return out


def _merge_moments(state: np.ndarray | None, values: np.ndarray, width: int) -> np.ndarray:
    """Two counts, means and sums of centred products as one; state is flat: n, mean, products."""
    if state is None:
        return values
    k = int(np.sqrt(len(values) - 0.75) - 0.5)  # 1 + k + k^2 numbers
    n, m = state[0], values[0]
    gap = values[1 : k + 1] - state[1 : k + 1]
    products = state[k + 1 :] + values[k + 1 :] + (np.outer(gap, gap) * (n * m / (n + m))).ravel()
    return np.concatenate([[n + m], state[1 : k + 1] + gap * (m / (n + m)), products])


def _moments(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, _, x in _matrices(batch, "x"):
                y = held.value[width].whitened(x)
                if y.shape[1]:
                    mean = y.mean(axis=0)
                    own = np.concatenate([[len(y)], mean, ((y - mean).T @ (y - mean)).ravel()])
                    states[width] = _merge_moments(states.get(width), own, width)
        yield _state_rows(TaskContext.get().partitionId(), states)

    return run


def identity_errors(numbers: DataFrame, spaces: dict[int, Space]) -> dict[int, float]:
    """The largest distance of the covariance of whitened rows from the identity, by length."""
    held = numbers.sparkSession.sparkContext.broadcast(spaces)
    out = {}
    for width, state in tree_reduced(numbers.select("x").mapInArrow(_moments(held), _STATE_DDL), _merge_moments, numbers.rdd.getNumPartitions()).items():
        k = spaces[width].components.shape[1]
        out[width] = float(np.abs(state[k + 1 :].reshape(k, k) / state[0] - np.eye(k)).max())
    return out


def squares(deviations: np.ndarray) -> list[int | None]:
    """The exact sum of squares of each row, None where it is beyond a long."""
    rough = (deviations.astype(float) ** 2).sum(axis=1)
    exact = [int(s) for s in (deviations * deviations).sum(axis=1)] if rough.max(initial=0) < 2.0**62 else [sum(int(v) ** 2 for v in row) for row in deviations]
    return [s if s < 1 << 63 else None for s in exact]


def _rows(held):
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces, errors = held.value
        for batch in batches:
            for width, at, x in _matrices(batch, "x"):
                space, rows = spaces[width], len(at)
                if not (k := space.components.shape[1]):
                    continue
                each = pa.array(np.repeat(at, k))
                deviation = pa.array(squares(space.means.deviations(x)), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k)))
                columns = [batch.column("vec_id").take(each), np.tile(np.arange(1, k + 1, dtype=np.int32), rows), np.full(rows * k, space.means.n), deviation, space.whitened(x).ravel(), np.tile(space.explained, rows), np.full(rows * k, errors[width])]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=schema)

    return run


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): for each row that takes
    part and each of its first components, counted from 1 by falling variance."""
    numbers = scratch(narrow(rows).transform(whole_numbers, id_col, vector_col, scale, shift), "whiten-numbers")
    spaces = fit(numbers, most)
    held = rows.sparkSession.sparkContext.broadcast((spaces, identity_errors(numbers, spaces)))
    return numbers.select("vec_id", "x").mapInArrow(_rows(held), "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
