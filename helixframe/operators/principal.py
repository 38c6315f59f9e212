"""Principal components of sparse rows by block Krylov iteration.

Rows stay in their tasks. A pass multiplies the centred rows by a thin block of directions and the
result by the rows again; what the tasks give is a block of (features x directions) each, added up by
feature ranges in two rounds. A Krylov basis of a few passes holds the leading directions to rounding;
it and the small matrix that it makes of the covariance are all that the driver sees, and their size is
the number of features (fixed by the alphabet and the length of a word), whatever the rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.schemas import ALPHABET, KMER
from helixframe.storage import release, scratch

#: Directions beyond those asked for, passes at most, and the change of a share that ends them.
SPARE, PASSES, CHANGE = 20, 8, 1e-8
#: Rows that are filled up at once, features of a range when blocks are added, and tasks of a first sum.
ROWS, RANGE, LANES = 256, 1000, 32


def gathered(features: DataFrame, ids: DataFrame) -> DataFrame:
    """(seq_id, at, x): the features of each row as two arrays, rows of ids without one as well."""
    held = features.groupBy("seq_id").agg(F.sort_array(F.collect_list(F.struct("feature", "freq"))).alias("f"))
    none = F.array().cast("array<int>"), F.array().cast("array<double>")
    both = ids.select("seq_id").join(held, "seq_id", "left")
    return both.select("seq_id", F.coalesce(F.transform("f", lambda s: s["feature"].cast("int")), none[0]).alias("at"), F.coalesce(F.transform("f", lambda s: s["freq"].cast("double")), none[1]).alias("x"))


def _filled(frame: pd.DataFrame, width: int, means: np.ndarray) -> Iterator[np.ndarray]:
    """Centred rows, some at a time."""
    for low in range(0, len(frame), ROWS):
        part = frame.iloc[low : low + ROWS]
        rows = np.zeros((len(part), width))
        rows[np.repeat(np.arange(len(part)), part["at"].map(len)), np.concatenate([np.asarray(a, np.int64) for a in part["at"]])] = np.concatenate([np.asarray(x, float) for x in part["x"]])
        yield rows - means


def _summed(width: int, columns: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b, float) for b in frame["block"])
        return pd.DataFrame({"part": [key[0]], "range": [key[1]], "block": [total.tobytes()]})

    return run


def product(rows: DataFrame, width: int, means: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The centred rows, transposed, times themselves times the directions."""
    sent = rows.sparkSession.sparkContext.broadcast((means, directions))
    columns = directions.shape[1]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own_means, own = sent.value
        total = np.zeros((width, columns))
        for frame in frames:
            for x in _filled(frame, width, own_means):
                total += x.T @ (x @ own)
        part = TaskContext.get().partitionId()
        yield pd.DataFrame([(part, r, total[r * RANGE : (r + 1) * RANGE].tobytes()) for r in range(-(-width // RANGE))], columns=["part", "range", "block"])

    schema = "part long, range int, block binary"
    blocks = rows.select("at", "x").mapInPandas(run, schema).withColumn("part", F.pmod("part", F.lit(LANES)))
    for part in ("part", F.lit(0).cast("long").alias("part")):  # by lanes, then all
        blocks = blocks.select(part, "range", "block").groupBy("part", "range").applyInPandas(_summed(width, columns), schema)
    return np.concatenate([np.frombuffer(r.block, float).reshape(-1, columns) for r in sorted(blocks.collect(), key=lambda r: r.range)])


def _orthonormal(block: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """The part of a block that lies outside the basis, twice cleaned, as unit columns."""
    size = np.linalg.norm(block, axis=0).max(initial=0)
    for _ in range(2):
        for q in basis:
            block = block - q @ (q.T @ block)
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    return u[:, s > 1e-10 * max(size, 1e-300)]


def fit(rows: DataFrame, most: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(means, directions as columns, share of the variance of each), at most `most` directions. A first
    block is drawn at random; each pass adds what the covariance makes of the last one."""
    count = rows.count()
    placed = rows.select(F.posexplode("at").alias("k", "feature"), "x").select("feature", F.get("x", F.col("k")).alias("v"))
    means, squares = np.zeros(width), 0.0
    for r in placed.groupBy("feature").agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q")).collect():
        means[r.feature] = r.s / max(count, 1)
        squares += r.q
    variance = max(squares - count * float(means @ means), 0.0)
    if variance <= 1e-14 * max(squares, 1e-300):
        return means, np.zeros((width, 0)), np.zeros(0)
    block = np.random.default_rng(0).standard_normal((width, min(most + SPARE, max(1, count), width)))
    basis: list[np.ndarray] = []
    images: list[np.ndarray] = []
    before = np.zeros(0)
    for _ in range(PASSES):
        new = _orthonormal(block, basis)
        if not new.shape[1]:
            break
        basis.append(new)
        images.append(block := product(rows, width, means, new))
        whole, image = np.hstack(basis), np.hstack(images)
        small = whole.T @ image
        values, vectors = np.linalg.eigh((small + small.T) / 2)
        values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
        shares = values[:most] / variance
        if len(before) == len(shares) and np.abs(shares - before).max() < CHANGE:
            break
        before = shares
    keep = int((values[:most] > 1e-12).sum())
    return means, whole @ vectors[:, :keep], values[:keep] / variance


def components(features: DataFrame, ids: DataFrame, most: int = 50, width: int = len(ALPHABET) ** KMER) -> tuple[DataFrame, pd.DataFrame]:
    """((seq_id, scores), shares): the place of each row of ids on the components, at most `most`, and a
    frame (pc, share). features are (seq_id, feature, freq), numbered under `width`. A component points
    the way that its score of the largest size does. Rows without variance have one score, zero."""
    rows = scratch(gathered(features, ids), "pca-rows")
    means, directions, shares = fit(rows, most, width)
    if not directions.shape[1]:
        directions, shares = np.zeros((width, 1)), np.zeros(1)
    sent = rows.sparkSession.sparkContext.broadcast((means, directions))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own_means, own = sent.value
        for frame in frames:
            scores = [x @ own for x in _filled(frame, width, own_means)]
            yield pd.DataFrame({"seq_id": frame["seq_id"], "scores": list(np.concatenate(scores)) if scores else []})

    raw = scratch(rows.mapInPandas(run, "seq_id string, scores array<double>"), "pca-scores")
    release(rows)
    size = F.struct(F.abs(F.col("value")), F.col("seq_id"))
    ends = raw.select("seq_id", F.posexplode("scores").alias("pc", "value")).groupBy("pc").agg(F.signum(F.max_by("value", size)).alias("sign")).collect()
    signs = F.array(*[F.lit(float(r.sign) or 1.0) for r in sorted(ends, key=lambda r: r.pc)]).cast("array<double>")
    turned = F.zip_with("scores", signs, lambda v, s: v * s)
    return raw.select("seq_id", turned.alias("scores")), pd.DataFrame({"pc": range(1, len(shares) + 1), "share": shares})
