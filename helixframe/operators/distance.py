"""Alignment distances and all-vs-all search."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.kernels import align
from helixframe.operators.kmers import counts, pair_spine


@F.pandas_udf(T.IntegerType())
def nw_score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([align.global_score(x, y) for x, y in zip(a, b, strict=True)], dtype="int64")


@F.pandas_udf(T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())]))
def nw_alignment(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([align.global_alignment(x, y) for x, y in zip(a, b, strict=True)], columns=["a", "b"])


def alignment_distances(seqs: DataFrame, parts: int = 64) -> DataFrame:
    """(id_i, id_j, score, distance) of all pairs of a sample, one alignment per pair. The pairs
    are spread anew: they are few rows and much work."""
    pairs = pair_spine(seqs.select("seq_id"))
    a = seqs.select(F.col("seq_id").alias("id_i"), F.col("seq").alias("seq_i"))
    b = seqs.select(F.col("seq_id").alias("id_j"), F.col("seq").alias("seq_j"))
    spread = pairs.join(a, "id_i").join(b, "id_j").repartition(parts, "id_i", "id_j")
    scored = spread.select("id_i", "id_j", nw_score("seq_i", "seq_j").alias("score"), F.greatest(F.length("seq_i"), F.length("seq_j")).alias("longest"))
    return scored.withColumn("distance", F.greatest(F.lit(0.0), F.lit(1.0) - F.col("score") / F.nullif("longest", F.lit(0))))


#: Published statistics of ungapped scores for +2/-1 letters: used to turn scores into bits.
LAMBDA, KAPPA = 0.625, 0.41
_HIT = "query string, target string, fident double, alnlen int, mismatch int, gapopen int, qstart int, qend int, tstart int, tend int, evalue double, bits double"
_COLUMNS = [c.split()[0] for c in _HIT.split(", ")]
#: Letters of a seed, seeds that a diagonal must have, letters that these may lie apart, and targets with
#: a k-mer beyond which it is no seed.
SEED, SEEDS, APART, FREQUENT = 3, 2, 40, 5000


def candidates(queries: DataFrame, targets: DataFrame | None = None, k: int = SEED, seeds: int = SEEDS, frequent: int | None = FREQUENT) -> DataFrame:
    """(query, target): pairs with at least so many common k-mers, repeated ones as often as both have
    them. Without targets, the queries are held against themselves, each pair once. A k-mer that more
    than `frequent` targets have brings no pair, which bounds what one k-mer can make of the join; None
    takes all. Pairs are counted where they are made before they are shuffled."""
    own = counts(queries, k)
    others = (own if targets is None else counts(targets, k)).select(F.col("seq_id").alias("target"), "kmer", F.col("n").alias("m"))
    if frequent is not None:
        others = others.join(others.groupBy("kmer").agg(F.count(F.lit(1)).alias("having")).filter(F.col("having") > frequent), "kmer", "left_anti")
    met = own.withColumnRenamed("seq_id", "query").join(others, "kmer")
    if targets is None:
        met = met.filter("query <= target")
    return met.groupBy("query", "target").agg(F.sum(F.least("n", "m")).alias("common")).filter(F.col("common") >= seeds).select("query", "target")


class _Rule:
    """How letters and gaps score, and what a score is worth against a database."""

    def __init__(self, match: int, mismatch: int, gap_open: int, gap_extend: int, table: dict[str, dict[str, int]] | None, evalue: float, gaps: int):
        self.letters, self.scores = (match, mismatch, table), (match, mismatch, gap_open, gap_extend, table)
        self.gap_open, self.evalue, self.gaps = gap_open, evalue, gaps

    def bits(self, scores: np.ndarray) -> np.ndarray:
        return (LAMBDA * scores - log(KAPPA)) / log(2)

    def chance(self, scores: np.ndarray, lengths: np.ndarray, letters: np.ndarray) -> np.ndarray:
        return lengths * letters * 2.0 ** -self.bits(scores)

    def least(self, lengths: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The score that the best part without a gap has at least, if an alignment with up to so many
        gaps passes: its parts together are worth the score and what the gaps cost."""
        score = np.ceil((np.log(np.maximum(lengths, 1) * letters / self.evalue) + log(KAPPA)) / LAMBDA - 1e-9)
        return np.maximum(1, np.minimum(score, np.ceil((score + self.gaps * self.gap_open) / (self.gaps + 1) - 1e-9)))


def _chunks(frame: pd.DataFrame, cells: int, square: bool) -> Iterator[pd.DataFrame]:
    """Rows of a frame, ordered by length, as many as fill so many cells when filled up; with square,
    cells of whole matrices."""
    a, b = frame["seq_q"].str.len().to_numpy(), frame["seq_t"].str.len().to_numpy()
    order = np.lexsort((b, a))
    low, widest = 0, (0, 0)
    for high, at in enumerate(order):
        wider = max(widest[0], int(a[at])), max(widest[1], int(b[at]))
        if high > low and (high - low + 1) * (wider[1] + 1) * ((wider[0] + 1) if square else 1) > cells:
            yield frame.iloc[order[low:high]]
            low, wider = high, (int(a[at]), int(b[at]))
        widest = wider
    if low < len(order):
        yield frame.iloc[order[low:]]


def _ungapped(rule: _Rule, cells: int, k: int, seeds: int, apart: int):
    """Rows whose best score without a gap, on a diagonal with enough seeds, may belong to an alignment
    that passes, with that score."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in _chunks(frame, cells, False):
                found = align.diagonal_scores(part["seq_q"].tolist(), part["seq_t"].tolist(), k, seeds, apart, *rule.letters)
                shorter = np.minimum(part["seq_q"].str.len(), part["seq_t"].str.len()).to_numpy(float)
                passes = found >= rule.least(shorter, part["letters"].to_numpy())
                yield part.assign(ungapped=found).loc[passes, ["query", "target", "seq_q", "seq_t", "letters", "ungapped"]]

    return run


def _aligned(rule: _Rule, cells: int, both: bool):
    """Hits of rows, and with both those of the other direction as well."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in _chunks(frame, cells, False):
                part = part.assign(score=align.pair_scores(part["seq_q"].tolist(), part["seq_t"].tolist(), *rule.scores))
                if both:
                    turned = part[part["query"] != part["target"]].rename(columns={"query": "target", "target": "query", "seq_q": "seq_t", "seq_t": "seq_q"})
                    part = pd.concat([part, turned[part.columns]])
                chance = rule.chance(part["score"].to_numpy(float), part["seq_q"].str.len().to_numpy(float), part["letters"].to_numpy())
                good = part.assign(evalue=chance, bits=rule.bits(part["score"].to_numpy(float)))[(chance <= rule.evalue) & (part["score"] > 0).to_numpy()]
                for some in _chunks(good, 64 * cells, True):
                    found = pd.DataFrame(align.pair_alignments(some["seq_q"].tolist(), some["seq_t"].tolist(), *rule.scores), index=some.index)
                    whole = pd.concat([some, found.drop(columns="score")], axis=1)
                    yield whole.assign(fident=whole["identities"] / whole["alnlen"])[_COLUMNS]

    return run


def search(queries: DataFrame, targets: DataFrame | None = None, best: int | None = None, k: int = SEED, seeds: int = SEEDS, apart: int = APART, frequent: int | None = FREQUENT, evalue: float = 10.0, match: int = 2, mismatch: int = -1, gap_open: int = 10, gap_extend: int = 1, table: dict[str, dict[str, int]] | None = None, gaps: int = 1, parts: int | None = None, cells: int = 1 << 16) -> DataFrame:
    """Hits of queries against targets, or against themselves, in the twelve columns of a hit table.

    1. Pairs meet on common k-mers (`candidates`).
    2. Their diagonals with two seeds (or one) at most `apart` letters from each other are scored without
       gaps. What cannot be part of an alignment with up to `gaps` gaps that passes goes; with `best`,
       only that many targets of each query stay, by this score, before anything is aligned.
    3. What is left is scored with affine gaps, many pairs at once in two rows of memory each, and what
       passes by its e-value (Karlin and Altschul, over all targets) is aligned in full.

    The exact way is k = 1, seeds = 1, frequent = None and many gaps: each alignment has a common letter
    on a diagonal. More letters and seeds make fewer candidates, and weak alignments without two seeds
    are lost. Letters score by a substitution table if one is given, else by match and mismatch; results
    are not those of another search tool. Pairs, not queries, are dealt to tasks, so that a query with
    very many targets is spread: `parts` of them, few bytes and much work, two for each core if not
    stated. Empty sequences have no hits; of equal ids each row is searched."""
    rule = _Rule(match, mismatch, gap_open, gap_extend, table, evalue, gaps)
    base, spark = (queries if targets is None else targets), queries.sparkSession
    parts = parts or 2 * spark.sparkContext.defaultParallelism
    size = base.agg(F.sum(F.length("seq")).cast("double").alias("letters"))
    q = queries.select(F.col("seq_id").alias("query"), F.col("seq").alias("seq_q"))
    t = base.select(F.col("seq_id").alias("target"), F.col("seq").alias("seq_t"))
    found = candidates(queries, targets, k, seeds, frequent).join(q, "query").join(t, "target").join(F.broadcast(size))  # one row
    dealt = lambda rows: rows.repartition(parts, "query", "target")
    likely = dealt(found).mapInPandas(_ungapped(rule, cells, k, seeds, apart), "query string, target string, seq_q string, seq_t string, letters double, ungapped long")
    both = targets is None
    if best is not None:
        if both:  # each direction has its own best
            turned = likely.filter("query <> target").select(F.col("target").alias("query"), F.col("query").alias("target"), F.col("seq_t").alias("seq_q"), F.col("seq_q").alias("seq_t"), "letters", "ungapped")
            likely, both = likely.unionByName(turned), False
        nth = F.row_number().over(W.partitionBy("query").orderBy(F.desc("ungapped"), "target"))
        likely = dealt(likely.withColumn("nth", nth).filter(F.col("nth") <= best).drop("nth"))
    return likely.mapInPandas(_aligned(rule, cells, both), _HIT)
