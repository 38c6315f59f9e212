"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.storage import release, scratch


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to the smallest node around u."""
    both = _both(edges)
    least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    kept = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return kept.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).filter("a <> b").distinct()


def connected_components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, root) for each node of an edge (a, b): root is the smallest node it can reach.

    Edges must have a < b, without nulls; repeated edges do no harm. Each step is written to the
    shared folder. Steps end when the edges are stars, checked by count and an order-free hash."""
    now, seen = scratch(edges.select("a", "b").distinct(), "components"), None
    for _ in range(most):
        large = scratch(_large_star(now), "components")
        after = scratch(_small_star(large), "components")
        release(now, large)
        now = after
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components have not settled in {most} steps")
    roots = now.select("a").distinct().select(F.col("a").alias("node"), F.col("a").alias("root"))
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots)
