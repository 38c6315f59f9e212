"""Analytics over the hit table (query, target, fident, alnlen, evalue, bits)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.schemas import EVALUE_THRESHOLDS, IDENTITY_BUCKETS


def without_self(hits: DataFrame) -> DataFrame:
    return hits.filter(F.col("query") != F.col("target"))


def top_hits(hits: DataFrame, query: str, evalue: float = 0.01, most: int = 50, ties: tuple[str, ...] = ()) -> DataFrame:
    """The best other targets of a query. Filters reach the scan; the limit is a top-k per task."""
    kept = hits.filter((F.col("query") == query) & (F.col("target") != query) & (F.col("evalue") <= evalue))
    return kept.orderBy("evalue", "target", *ties).limit(most)


def query_status(hits: DataFrame, seqs: DataFrame, query: str) -> DataFrame:
    """One row: whether a query has hits, is only in the database, or is unknown."""
    has = hits.filter(F.col("query") == query).limit(1).agg(F.count(F.lit(1)).alias("with_hits"))
    known = seqs.filter(F.col("seq_id") == query).limit(1).agg(F.count(F.lit(1)).alias("known"))
    status = F.when(F.col("with_hits") > 0, "hits").when(F.col("known") > 0, "no hits").otherwise("not found")
    return has.crossJoin(F.broadcast(known)).select(F.lit(query).alias("query"), status.alias("status"))  # one row each


def totals(hits: DataFrame) -> DataFrame:
    """Rows, rows without self-hits, distinct queries and targets (self-hits included)."""
    return hits.agg(F.count(F.lit(1)).alias("total"), F.count(F.when(F.col("query") != F.col("target"), 1)).alias("non_self"), F.countDistinct("query").alias("queries"), F.countDistinct("target").alias("targets"))


def evalue_thresholds(hits: DataFrame) -> DataFrame:
    """(threshold, n, pct) of hits at or under each threshold, in one pass."""
    own = without_self(hits).agg(F.count(F.lit(1)).alias("all"), *[F.count(F.when(F.col("evalue") <= t, 1)).alias(f"t{i}") for i, t in enumerate(EVALUE_THRESHOLDS)])
    rows = F.array(*[F.struct(F.lit(i).alias("nth"), F.lit(t).alias("threshold"), F.col(f"t{i}").alias("n")) for i, t in enumerate(EVALUE_THRESHOLDS)])
    return own.select("all", F.explode(rows).alias("r")).select("r.nth", "r.threshold", "r.n", (F.lit(100.0) * F.col("r.n") / F.nullif("all", F.lit(0))).alias("pct"))


def identity_buckets(hits: DataFrame) -> DataFrame:
    """(lo, hi, n, pct); buckets are open above, and full identity has a row of its own."""
    x = F.col("fident")
    own = without_self(hits).agg(F.count(F.lit(1)).alias("all"), *[F.count(F.when((x >= a) & (x < b), 1)).alias(f"b{i}") for i, (a, b) in enumerate(IDENTITY_BUCKETS)], F.count(F.when(x == 1.0, 1)).alias("full"))
    rows = [F.struct(F.lit(a).alias("lo"), F.lit(b).alias("hi"), F.col(f"b{i}").alias("n")) for i, (a, b) in enumerate(IDENTITY_BUCKETS)]
    rows.append(F.struct(F.lit(1.0).alias("lo"), F.lit(1.0).alias("hi"), F.col("full").alias("n")))
    return own.select("all", F.explode(F.array(*rows)).alias("r")).select("r.lo", "r.hi", "r.n", (F.lit(100.0) * F.col("r.n") / F.nullif("all", F.lit(0))).alias("pct"))


def hits_per_query(hits: DataFrame) -> DataFrame:
    return without_self(hits).groupBy("query").agg(F.count(F.lit(1)).alias("n"))


def busiest_queries(hits: DataFrame, most: int = 10) -> DataFrame:
    return hits_per_query(hits).orderBy(F.desc("n"), "query").limit(most)


def best_per_pair(hits: DataFrame) -> DataFrame:
    return hits.groupBy("query", "target").agg(F.min("evalue").alias("evalue"))


def export_records(hits: DataFrame, residues: DataFrame) -> DataFrame:
    """Header and sequence of each hit's target that has a residue sequence. The join is Catalyst's
    choice: a short top-k list is broadcast when it is known to be small."""
    own = hits.join(residues.select(F.col("seq_id").alias("target"), "seq"), "target")
    return own.select("target", F.format_string(">%s evalue=%.2e fident=%.3f", "target", "evalue", "fident").alias("header"), "seq", "fident")
