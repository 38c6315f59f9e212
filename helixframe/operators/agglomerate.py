"""Agglomerative clustering by rounds of mutual nearest neighbours.

The distances are one row of numbers for each cluster. A round takes all pairs that are each other's
nearest (of equally near ones, that of the lower number, which is also the pair that would be merged
first one at a time): for average, weighted and Ward's linkage no other merge can come nearer to either,
so the pairs of a round are those of the one-at-a-time order. The two rows of a pair meet in a task and
become one by the update of Lance and Williams; all other rows replace two columns by one where they
are. The driver sees the nearest neighbour of each cluster and the merges, some numbers a row, while the
squares stay in tasks. As soon as `LAST` clusters are left, a matrix of fixed size, one task merges them
one at a time.

Very many equal distances make many rounds, as of a group that is equally near only one pair goes first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.kernels import linkage
from helixframe.storage import release, scratch

#: Clusters that one task merges to the end.
LAST = 512
_STATE = "node long, row array<double>, nearest long, distance double"


def _rows(frame: pd.DataFrame) -> np.ndarray:
    return np.array([np.asarray(r, float) for r in frame["row"]]).reshape(len(frame), -1)


def _told(nodes: list[int], rows: np.ndarray, names: np.ndarray) -> pd.DataFrame:
    """Rows with the nearest cluster of each."""
    at = rows.argmin(axis=1)
    return pd.DataFrame({"node": nodes, "row": list(rows), "nearest": np.asarray(names)[at], "distance": rows[np.arange(len(rows)), at]})


class _Round:
    """The merges of a round, as places in the rows before and after it."""

    def __init__(self, method: str, names: list[int], after: list[int], pairs: list[tuple[int, int, float]], made: list[int], sizes: dict[int, float]):
        self.method, self.after, self.first = method, np.array(after), made[0]
        self.place = {x: k for k, x in enumerate(names)}
        self.sizes = np.array([sizes[x] for x in names])
        self.left, self.right = (np.array([self.place[p[side]] for p in pairs]) for side in (0, 1))
        self.gaps, self.pairs = np.array([p[2] for p in pairs]), pairs
        new = {c: k for k, c in enumerate(made)}
        self.kept = [k for k, x in enumerate(after) if x not in new]
        self.stay = [self.place[after[k]] for k in self.kept]
        self.at = [k for k, x in enumerate(after) if x in new]
        self.order = [new[after[k]] for k in self.at]
        self.own = {after[k]: k for k in self.at}

    def sizes_of(self, nodes) -> np.ndarray:
        return self.sizes[[self.place[x] for x in nodes]]

    def shrunk(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Rows over the clusters after the round; sizes are those of the rows' own clusters."""
        out = np.empty((len(rows), len(self.after)))
        out[:, self.kept] = rows[:, self.stay]
        a, b = self.left[self.order], self.right[self.order]
        out[:, self.at] = linkage.updated(self.method, rows[:, a], rows[:, b], self.sizes[a], self.sizes[b], sizes[:, None], self.gaps[self.order])
        return out

    def joined(self, cluster: int, rows: dict[int, np.ndarray]) -> np.ndarray:
        """The row of a new cluster from those of its parts."""
        a, b, gap = self.pairs[cluster - self.first]
        i, j = self.place[a], self.place[b]
        one = linkage.updated(self.method, rows[a], rows[b], self.sizes[i], self.sizes[j], self.sizes, gap)
        one[[i, j]] = np.inf
        row = self.shrunk(one[None], self.sizes[[i]] + self.sizes[j])[0]
        row[self.own[cluster]] = np.inf
        return row


def agglomerate(rows: DataFrame, method: str = "average", last: int = LAST) -> np.ndarray:
    """Merges (left, right, distance, size) of rows (node, row): nodes are counted from 0, and row has the
    distances to all of them in order."""
    spark = rows.sparkSession
    squared = method == "ward"

    def begun(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                own = _rows(frame)
                own = own**2 if squared else own
                own[np.arange(len(frame)), frame["node"].to_numpy()] = np.inf
                yield _told(frame["node"].tolist(), own, np.arange(own.shape[1]))

    state = scratch(rows.select("node", "row").mapInPandas(begun, _STATE), "linkage-rows")
    n = state.count()
    names, sizes, merges = list(range(n)), dict.fromkeys(range(n), 1.0), []
    while len(names) > max(last, 1):
        near = {r.node: (r.nearest, r.distance) for r in state.select("node", "nearest", "distance").collect()}
        pairs = [(a, near[a][0], near[a][1]) for a in names if near[near[a][0]][0] == a]
        place = {node: k for k, node in enumerate(names)}
        pairs = [p for p in pairs if place[p[0]] < place[p[1]]]
        made = [n + len(merges) + k for k in range(len(pairs))]
        for (a, b, distance), c in zip(pairs, made, strict=True):
            merges.append((a, b, distance, int(sizes[a] + sizes[b])))
            sizes[c] = sizes[a] + sizes[b]
        gone = {x for a, b, _ in pairs for x in (a, b)}
        # The order of clusters is that of a one-at-a-time run, as far as it is known.
        _, number = linkage.numbered(merges, n)
        after = sorted([x for x in names if x not in gone] + made, key=number.__getitem__)
        told = spark.sparkContext.broadcast(_Round(method, names, after, pairs, made, sizes))
        into = spark.createDataFrame([(x, c) for (a, b, _), c in zip(pairs, made, strict=True) for x in (a, b)], "node long, into long")

        def alone(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                if len(frame):
                    yield _told(frame["node"].tolist(), told.value.shrunk(_rows(frame), told.value.sizes_of(frame["node"])), told.value.after)

        def joined(frame: pd.DataFrame) -> pd.DataFrame:
            c = int(frame["into"].iloc[0])
            return _told([c], told.value.joined(c, dict(zip(frame["node"], _rows(frame), strict=True)))[None], told.value.after)

        marked = state.join(F.broadcast(into), "node", "left")  # a row for each cluster that is merged
        kept = marked.filter("into IS NULL").select("node", "row").mapInPandas(alone, _STATE)
        new = marked.filter("into IS NOT NULL").select("into", "node", "row").groupBy("into").applyInPandas(joined, _STATE)
        nxt = scratch(kept.unionByName(new), "linkage-rows")
        release(state)
        state, names = nxt, after

    def ended(frame: pd.DataFrame) -> pd.DataFrame:
        by = dict(zip(frame["node"], _rows(frame), strict=True))
        found = linkage.agglomerated(np.array([by[x] for x in names]), np.array([sizes[x] for x in names]), list(range(len(names))), method)
        return pd.DataFrame(found, columns=["left", "right", "distance", "size"]).astype({"left": int, "right": int, "size": int})

    if len(names) > 1:
        done = state.select("node", "row", F.lit(0).alias("all")).groupBy("all").applyInPandas(ended, "left long, right long, distance double, size long").collect()
        begin = n + len(merges)
        name = lambda k: names[k] if k < len(names) else begin + k - len(names)
        merges += [(name(r["left"]), name(r["right"]), r["distance"], r["size"]) for r in done]
    release(state)
    out = np.array(linkage.numbered(merges, n)[0], float).reshape(-1, 4)
    if squared:
        out[:, 2] = np.sqrt(np.maximum(out[:, 2], 0))
    return out
