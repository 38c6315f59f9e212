"""Principal components, clusters and pooled embeddings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.kernels import linkage
from helixframe.operators import agglomerate
from helixframe.schemas import LAST_MERGES

#: Rows of a dendrogram at most: their distances are as many squared.
MOST_ROWS = 20_000


def scree(shares: DataFrame) -> DataFrame:
    """(pc, share, cumulative): a row per component, at most a few dozen."""
    return shares.withColumn("cumulative", F.sum("share").over(W.orderBy("pc").rowsBetween(W.unboundedPreceding, 0)))


def distance_rows(scores: DataFrame) -> tuple[list[str], DataFrame]:
    """The ids in order, and (node, row): the distances of each row of scores (seq_id, scores) to all.
    The scores of all rows are sent to the tasks, `MOST_ROWS` of some dozen numbers at most."""
    held = scores.limit(MOST_ROWS + 1).collect()
    if len(held) > MOST_ROWS:
        raise ValueError(f"a dendrogram of more than {MOST_ROWS} rows is no sample")
    held.sort(key=lambda r: r.seq_id)
    ids = [r.seq_id for r in held]
    sent = scores.sparkSession.sparkContext.broadcast(({i: k for k, i in enumerate(ids)}, np.array([r.scores for r in held], float).reshape(len(held), -1)))

    def run(frames):
        place, x = sent.value
        squares = (x**2).sum(axis=1)
        for frame in frames:
            at = [place[i] for i in frame["seq_id"]]
            rows = np.sqrt(np.maximum(squares[at, None] + squares[None, :] - 2 * x[at] @ x.T, 0))
            yield pd.DataFrame({"node": at, "row": list(rows)})

    return ids, scores.select("seq_id").mapInPandas(run, "node long, row array<double>")


def clustered(scores: DataFrame, method: str = "ward") -> tuple[list[str], np.ndarray]:
    """The ids in order and the merges of a clustering of component scores."""
    ids, rows = distance_rows(scores)
    return ids, agglomerate.agglomerate(rows, method)


def clusters(scores: DataFrame, many: int = 8, method: str = "ward") -> DataFrame:
    """(seq_id, cluster) of the component scores, by Ward's or by average linkage."""
    ids, merges = clustered(scores, method)
    return scores.sparkSession.createDataFrame(list(zip(ids, linkage.cut(merges, len(ids), many), strict=True)), "seq_id string, cluster long")


def last_merges(scores: DataFrame, method: str = "ward", most: int = LAST_MERGES) -> DataFrame:
    """(step, left, right, distance, size): the last merges of a clustering of the component scores,
    as a cut dendrogram shows them."""
    ids, merges = clustered(scores, method)
    rows = linkage.last_merges(merges, most)
    first = max(0, len(ids) - 1 - len(rows))
    return scores.sparkSession.createDataFrame([(first + k, *r) for k, r in enumerate(rows)], "step long, left long, right long, distance double, size long")


def cluster_summary(members: DataFrame, seqs: DataFrame, entropies: DataFrame) -> DataFrame:
    """(cluster, size, mean_len, std_len, mean_entropy)."""
    joined = members.join(seqs.select("seq_id", F.length("seq").alias("len")), "seq_id").join(entropies, "seq_id")
    return joined.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.avg("len").alias("mean_len"), F.stddev_pop("len").alias("std_len"), F.avg("entropy").alias("mean_entropy"))


def mean_pool(vectors: DataFrame, *by: str, column: str = "embedding") -> DataFrame:
    """The mean of vectors by group, each position on its own."""
    places = vectors.select(*by, F.posexplode(column).alias("pos", "x"))
    means = places.groupBy(*by, "pos").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    ordered = F.sort_array(F.collect_list(F.struct("pos", "mean")))
    return means.groupBy(*by).agg(F.transform(ordered, lambda s: s["mean"]).alias(column))


def tsne(x: np.ndarray, perplexity: float = 30.0, steps: int = 500, seed: int = 0) -> np.ndarray:
    """Two-dimensional stochastic neighbour embedding of a bounded sample, exact gradients.

    Each coordinate has a gain that grows while its gradient keeps its direction and shrinks when it
    turns, and no point moves further in a step than a part of the map's extent: small samples, whose
    forces are large, settle instead of swinging."""
    n = len(x)
    if n < 3:
        return np.zeros((n, 2))
    squares = (x**2).sum(axis=1)
    d = np.maximum(squares[:, None] + squares[None, :] - 2 * x @ x.T, 0)
    target, p = np.log(min(perplexity, (n - 1) / 3)), np.zeros((n, n))
    for i in range(n):
        low, high, beta = 0.0, np.inf, 1.0
        row = np.delete(d[i], i)
        for _ in range(60):
            e = np.exp(-(row - row.min()) * beta)
            h = np.log(e.sum()) + beta * ((row - row.min()) * e).sum() / e.sum()
            if abs(h - target) < 1e-5:
                break
            low, high = (beta, high) if h > target else (low, beta)
            beta = beta * 2 if high == np.inf else (low + high) / 2
        p[i, np.arange(n) != i] = e / e.sum()
    p = np.maximum((p + p.T) / (2 * n), 1e-12)
    y = np.random.default_rng(seed).normal(0, 1e-4, (n, 2))
    speed, gains, rate = np.zeros_like(y), np.ones_like(y), max(n / 12, 10)
    for step in range(steps):
        s = (y**2).sum(axis=1)
        w = 1 / (1 + np.maximum(s[:, None] + s[None, :] - 2 * y @ y.T, 0))
        np.fill_diagonal(w, 0)
        force = ((12 if step < 100 else 1) * p - np.maximum(w / w.sum(), 1e-12)) * w
        grad = 4 * (force.sum(axis=1)[:, None] * y - force @ y)
        gains = np.maximum(np.where((grad > 0) == (speed > 0), gains * 0.8, gains + 0.2), 0.01)
        speed = (0.5 if step < 100 else 0.8) * speed - rate * gains * grad
        furthest = 0.1 * max(np.abs(y).max(), 1.0)
        speed *= np.minimum(1, furthest / np.maximum(np.linalg.norm(speed, axis=1, keepdims=True), 1e-300))
        y = y + speed
        y -= y.mean(axis=0)
    return y
