"""Windows, runs and interval joins over numbered rows, by blocks of numbers instead of one window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Numbers of a block.
BLOCK = 10_000


def sliding(rows: DataFrame, at: str, made: dict[str, tuple[Column, str]], before: int, after: int, block: int = BLOCK) -> DataFrame:
    """rows with columns that are a sum or mean ('sum', 'avg') of an expression over the rows from
    `before` numbers below to `after` above. Rows are numbered without gaps; each goes to its block, and
    to the blocks next to it whose windows reach it."""
    number = F.col(at)
    home = F.floor(number / block)
    low, high = F.floor(F.greatest(number - after, F.lit(0)) / block), F.floor((number + before) / block)
    spread = rows.withColumn("_home", home).withColumn("_block", F.explode(F.sequence(low, high)))
    w = W.partitionBy("_block").orderBy(at).rowsBetween(-before, after)
    told = spread.withColumns({name: getattr(F, kind)(value).over(w) for name, (value, kind) in made.items()})
    return told.filter(F.col("_home") == F.col("_block")).drop("_home", "_block")


def runs(rows: DataFrame, at: str, value: Column, sums: tuple[str, ...] = (), ends: tuple[str, ...] = (), block: int = BLOCK) -> DataFrame:
    """(start, end, value, sums, first_ and last_ of ends): runs of rows whose numbers follow each other
    and that share a value, with sums of columns and what columns are in their first and last row.

    Runs are found within blocks; what touches the edge of a block is put together in blocks of blocks,
    and so on, so that each step has a few pieces a block of the step before."""
    first, last = [f"first_{c}" for c in ends], [f"last_{c}" for c in ends]
    top = rows.agg(F.max(at)).first()[0]
    pieces = rows.select(F.col(at).cast("long").alias("start"), F.col(at).cast("long").alias("end"), value.alias("value"), *sums, *[F.col(c).alias(n) for n, c in zip(first, ends, strict=True)], *[F.col(c).alias(n) for n, c in zip(last, ends, strict=True)])
    columns, closed, size = pieces.columns, [], block
    while True:
        w = W.partitionBy("_block").orderBy("start")
        follows = (F.lag("end").over(w) == F.col("start") - 1) & F.lag("value").over(w).eqNullSafe(F.col("value"))
        marked = pieces.withColumn("_block", F.floor(F.col("start") / size)).withColumn("_new", F.when(follows, 0).otherwise(1))
        grouped = marked.withColumn("_run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).groupBy("_block", "_run")
        by = lambda c, pick: pick(F.col(c), F.col("start")).alias(c)
        pieces = grouped.agg(F.min("start").alias("_start"), F.max("end").alias("end"), F.first("value").alias("value"), *[F.sum(c).alias(c) for c in sums], *[by(c, F.min_by) for c in first], *[by(c, F.max_by) for c in last]).withColumnRenamed("_start", "start").select(*columns)
        if top is None or size > top:
            return reduce(DataFrame.unionByName, closed, pieces)
        edge = (F.col("start") % size == 0) | ((F.col("end") + 1) % size == 0)
        closed.append(pieces.filter(~edge))
        pieces, size = pieces.filter(edge), size * block


def within(points: DataFrame, at: str, intervals: DataFrame, start: str, end: str, width: int = BLOCK) -> DataFrame:
    """points joined with the intervals that hold them, ends included: intervals go to each bin of
    numbers that they touch and meet the points there, each once, as a point is in one bin."""
    bins = intervals.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    return points.withColumn("_bin", F.floor(F.col(at) / width)).join(bins, "_bin").filter(F.col(at).between(F.col(start), F.col(end))).drop("_bin")
