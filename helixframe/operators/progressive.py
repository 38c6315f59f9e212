"""Progressive alignment of families along their guide trees, many merges at a time.

A tree of n leaves is cut into pieces of at most `PIECE` merges each, from the leaves up. A piece can be
done as soon as the groups of rows that it starts from are there, so all pieces of a round are rows of
one stage: a balanced tree needs a round for each power of `PIECE`, and one that is a long chain as many
as its length asks for. A group is its profile, letters by column with how often and in which row they
come first; rows of letters are never carried. Each merge gives both sides the places of their columns
in the merged group; going down from the root the same way, these are put together to the place of every
letter of every sequence, from which the aligned rows are written."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.kernels import align, progressive
from helixframe.storage import release, scratch

#: Merges of a piece at most.
PIECE = 64


def pieces(left: np.ndarray, right: np.ndarray, most: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """(piece, round) of each merge of a tree, in the order of its steps. A piece is connected, named by
    its last merge, and has at most `most` merges; its round is one more than the last of those that it
    starts from."""
    n = len(left) + 1
    joined = [0] * (2 * n - 1)  # merges of the open piece under a node
    cut = [False] * (2 * n - 1)
    for step, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        for small, large in ((a, b),) if joined[a] <= joined[b] else ((b, a),):
            if joined[small] + joined[large] >= most:
                cut[large], joined[large] = True, 0
            if joined[small] + joined[large] >= most:
                cut[small], joined[small] = True, 0
        joined[n + step] = 1 + joined[a] + joined[b]
    piece, turn = np.zeros(n - 1, np.int64), np.zeros(n - 1, np.int64)
    of = {}
    for step in range(n - 2, -1, -1):
        node = n + step
        piece[step] = node if cut[node] or node not in of else of[node]
        for child in (int(left[step]), int(right[step])):
            of[child] = piece[step]
    first: dict[int, int] = {}
    for step in range(n - 1):
        for child in (int(left[step]), int(right[step])):
            if child >= n and piece[child - n] != piece[step]:
                first[int(piece[step])] = max(first.get(int(piece[step]), 0), first.get(int(piece[child - n]), 0) + 1)
    for step in range(n - 1):
        turn[step] = first.get(int(piece[step]), 0)
    return piece, turn


def _planned(frame: pd.DataFrame, most: int) -> pd.DataFrame:
    frame = frame.sort_values("step")
    n = len(frame) + 1
    piece, turn = pieces(frame["left"].to_numpy(), frame["right"].to_numpy(), most)
    return frame.assign(node=frame["step"] + n, piece=piece, round=turn)[["family", "node", "left", "right", "piece", "round"]]


class Profile:
    """What a group of aligned rows has in each column: counts and first rows of its letters."""

    def __init__(self, letters: np.ndarray, counts: np.ndarray, first: np.ndarray, rows: int):
        self.letters, self.counts, self.first, self.rows = letters, counts, first, rows  # letters x columns

    @classmethod
    def of(cls, seq: str) -> Profile:
        letters, number = np.unique(align.codes(seq), return_inverse=True)
        counts = np.zeros((len(letters), len(seq)), np.int32)
        counts[number, np.arange(len(seq))] = 1
        return cls(letters, counts, np.zeros_like(counts), 1)

    def consensus(self) -> str:
        """The most frequent letter of each column; of equals, the one that comes first in a row."""
        if not self.counts.shape[1]:
            return ""
        best = np.where(self.counts == self.counts.max(axis=0), self.first, np.iinfo(np.int32).max).argmin(axis=0)
        return self.letters[best].astype("<u4").tobytes().decode("utf-32-le")

    def placed(self, at: np.ndarray, letters: np.ndarray, width: int, after: int) -> tuple[np.ndarray, np.ndarray]:
        counts, first = np.zeros((len(letters), width), np.int32), np.full((len(letters), width), np.iinfo(np.int32).max, np.int32)
        rows = np.searchsorted(letters, self.letters)[:, None]
        counts[rows, at] = self.counts
        first[rows, at] = np.where(self.counts > 0, self.first + after, np.iinfo(np.int32).max)
        return counts, first

    def merged(self, other: Profile) -> tuple[Profile, np.ndarray, np.ndarray]:
        """Both as one, and the places of either's columns in it."""
        left, right = align.global_alignment(self.consensus(), other.consensus())
        own, others = (np.flatnonzero(align.codes(x) != ord(progressive.GAP)) for x in (left, right))
        letters = np.union1d(self.letters, other.letters)
        (c, f), (d, g) = self.placed(own, letters, len(left), 0), other.placed(others, letters, len(left), self.rows)
        return Profile(letters, c + d, np.minimum(f, g), self.rows + other.rows), own, others

    def packed(self) -> dict:
        return {"letters": self.letters.astype("<u4").tobytes(), "counts": self.counts.astype("<i4").tobytes(), "first": self.first.astype("<i4").tobytes(), "rows": self.rows}

    @classmethod
    def unpacked(cls, letters: bytes, counts: bytes, first: bytes, rows: int) -> Profile:
        own = np.frombuffer(letters, "<u4")
        shape = (len(own), -1 if len(own) else 0)
        return cls(own, np.frombuffer(counts, "<i4").reshape(shape), np.frombuffer(first, "<i4").reshape(shape), rows)


_GROUP = "family string, node long, letters binary, counts binary, first binary, rows int"
_MERGED = f"{_GROUP}, parent long, at array<int>"


def _merge_piece(frame: pd.DataFrame) -> pd.DataFrame:
    """One piece: rows of its merges (left, right) and of the groups that it starts from. Gives the
    group that it ends with, and for every node below the places of its columns in that."""
    groups = {r.node: Profile.unpacked(r.letters, r.counts, r.first, r.rows) for r in frame[frame["left"].isna()].itertuples()}
    inputs, ways, below = set(groups), {}, {}
    for r in frame[frame["left"].notna()].sort_values("node").itertuples():
        a, b = int(r.left), int(r.right)
        groups[r.node], own, other = groups.pop(a).merged(groups.pop(b))
        ways[a], ways[b], below[r.node] = own, other, (a, b)
    (top, group), family = next(iter(groups.items())), frame["family"].iloc[0]
    out = [{"family": family, "node": top, **group.packed(), "parent": None, "at": None}]
    todo = [(top, None)]
    while todo:  # down from the last merge, places in its columns
        node, at = todo.pop()
        for child in below.get(node, ()):
            place = ways[child] if at is None else at[ways[child]]
            todo.append((child, place))
            if child in inputs:
                out.append({"family": family, "node": child, "parent": top, "at": place.astype(np.int32)})
    return pd.DataFrame(out, columns=["family", "node", "letters", "counts", "first", "rows", "parent", "at"])


def _profiles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        if frame["seq"].str.contains(progressive.GAP, regex=False).any():
            raise ValueError("sequences to be aligned must not hold gaps")
        yield pd.DataFrame([{"family": f, "node": n, **Profile.of(s).packed()} for f, n, s in zip(frame["family"], frame["row"], frame["seq"], strict=True)])


@F.pandas_udf(T.StringType())
def _written(seq: pd.Series, at: pd.Series, width: pd.Series) -> pd.Series:
    out = []
    for s, places, n in zip(seq, at, width, strict=True):
        row = np.full(int(n), ord(progressive.GAP), "<u4")
        if len(s):
            row[places if places is not None else np.arange(len(s))] = align.codes(s)
        out.append(row.tobytes().decode("utf-32-le"))
    return pd.Series(out)


def align_families(seqs: DataFrame, merges: DataFrame, most: int = PIECE) -> DataFrame:
    """(family, seq_id, row, aligned) of sequences (family, seq_id, row, seq) along guide trees
    (family, step, left, right) whose leaves are the rows, counted from 0. Only the trees' few numbers
    a sequence lie together by family when they are cut into pieces."""
    plan = merges.select("family", F.col("step").cast("long").alias("step"), F.col("left").cast("long").alias("left"), F.col("right").cast("long").alias("right"))
    plan = scratch(plan.groupBy("family").applyInPandas(lambda frame: _planned(frame, most), "family string, node long, left long, right long, piece long, round long"), "align-plan")
    leaves = scratch(seqs.select("family", F.col("row").cast("long").alias("row"), "seq_id", "seq"), "align-leaves")
    groups = scratch(leaves.select("family", "row", "seq").mapInPandas(_profiles, _GROUP), "align-groups")
    rounds = plan.agg(F.max("round")).first()[0]
    ways: list[DataFrame] = []
    none = [F.lit(None).cast("binary").alias(n) for n in ("letters", "counts", "first")]
    # Where each node goes: the piece of the merge that it enters, if that is another than its own.
    enters = plan.select("family", "piece", "round", F.explode(F.array("left", "right")).alias("node"), F.col("node").alias("over"))
    for turn in range(-1 if rounds is None else rounds + 1):
        here = plan.filter(F.col("round") == turn)
        starts = groups.join(enters.filter(F.col("round") == turn).select("family", "node", "piece"), ["family", "node"])
        rows = starts.select("family", "piece", "node", *[F.lit(None).cast("long").alias(n) for n in ("left", "right")], "letters", "counts", "first", "rows")
        rows = rows.unionByName(here.select("family", "piece", "node", "left", "right", *none, F.lit(None).cast("int").alias("rows")))
        done = scratch(rows.groupBy("family", "piece").applyInPandas(_merge_piece, _MERGED), f"align-round-{turn}")
        ways.append(done.filter("parent IS NOT NULL").select("family", "node", "parent", "at"))
        left = groups.join(starts.select("family", "node"), ["family", "node"], "left_anti")
        after = scratch(left.unionByName(done.filter("parent IS NULL").select(*groups.columns)), "align-groups")
        release(groups)
        groups = after
    # What is left is the whole alignment of each family: its width, and from there the ways down.
    width = F.when(F.octet_length("letters") > 0, F.octet_length("counts") / F.octet_length("letters")).otherwise(0).cast("int")
    placed = groups.select("family", "node", F.lit(None).cast("array<int>").alias("at"), width.alias("width"))
    parts = [placed]
    for way in reversed(ways):
        above = placed.select("family", F.col("node").alias("parent"), F.col("at").alias("over"), "width")
        inside = F.when(F.col("over").isNull(), F.col("at")).otherwise(F.transform("at", lambda x: F.get("over", x)))
        below = scratch(way.join(above, ["family", "parent"]).select("family", "node", inside.alias("at"), "width"), "align-places")
        parts.append(below)
        placed = reduce(DataFrame.unionByName, parts)
    whole = placed.select("family", F.col("node").alias("row"), "at", "width")
    return leaves.join(whole, ["family", "row"]).select("family", "seq_id", "row", _written("seq", "at", "width").alias("aligned"))
