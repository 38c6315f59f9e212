"""Work-queue bookkeeping: chunks, ordered deduplication, what remains, progress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.functions.text import percent_bucket
from helixframe.operators import ranges
from helixframe.storage import scratch


def numbered(rows: DataFrame, *order: str, block_rows: int = 200_000) -> DataFrame:
    """rows with nth, counted from 0 in an order. Ranges of the keys are numbered on their own and
    shifted by the counts before them, so no single task sorts everything; there are as many as the
    counted rows ask for. The ranges are written out at once: their bounds come from a sample, and
    both passes must see the same ones."""
    blocks = max(1, -(-rows.count() // block_rows))
    ranged = scratch(rows.repartitionByRange(blocks, *order).withColumn("_block", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    first = counts.select("_block", F.coalesce(F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_first"))
    inside = F.row_number().over(W.partitionBy("_block").orderBy(*order)) - 1
    # first has a row per block, some hundred bytes for each `block_rows` rows
    return ranged.withColumn("_inside", inside).join(F.broadcast(first), "_block").withColumn("nth", F.col("_first") + F.col("_inside")).drop("_block", "_first", "_inside")


def split_into(rows: DataFrame, chunks: int, *order: str) -> DataFrame:
    """rows with chunk: at most `chunks` runs of ceil(n / chunks), the last shorter, none empty."""
    total = rows.agg(F.greatest(F.ceil(F.count(F.lit(1)) / chunks), F.lit(1)).alias("_size"))
    return numbered(rows, *order).join(F.broadcast(total)).withColumn("chunk", F.floor(F.col("nth") / F.col("_size")).cast("long")).drop("_size")


def split_by(rows: DataFrame, size: int, *order: str) -> DataFrame:
    """rows with chunk: runs of a fixed size."""
    return numbered(rows, *order).withColumn("chunk", F.floor(F.col("nth") / size).cast("long"))


def call_batches(accessions: DataFrame, size: int = 50) -> DataFrame:
    """(chunk, accessions): the argument of one bulk call per chunk, comma-joined in order."""
    return split_by(accessions, size, "accession").groupBy("chunk").agg(F.array_join(F.sort_array(F.collect_list("accession")), ",").alias("accessions"))


def first_occurrences(rows: DataFrame, *order: str) -> DataFrame:
    """The first row of each accession in an order."""
    best = rows.groupBy("accession").agg(F.min(F.struct(*order)).alias("first"))
    return best.select("accession", "first.*")


def remaining(available: DataFrame, done: DataFrame) -> DataFrame:
    return available.select("accession").distinct().join(done.select("accession"), "accession", "left_anti")


def remove_completed(chunks: DataFrame, done: DataFrame) -> DataFrame:
    """Lines that stay; write them to a new folder."""
    return chunks.join(done.select("accession").distinct(), "accession", "left_anti")


def removal_report(chunks: DataFrame, done: DataFrame) -> DataFrame:
    """(file, removed, kept, deleted) of the chunk files, before anything is written."""
    marked = chunks.join(done.select("accession", F.lit(1).alias("_done")).distinct(), "accession", "left")
    counted = marked.groupBy("file").agg(F.count("_done").alias("removed"), (F.count(F.lit(1)) - F.count("_done")).alias("kept"))
    return counted.withColumn("deleted", F.col("kept") == 0)


def chunk_progress(chunks: DataFrame, done: DataFrame) -> DataFrame:
    """(file, done, total, pct) over distinct accessions of a file."""
    marked = chunks.select("file", "accession").distinct().join(done.select("accession", F.lit(1).alias("_done")).distinct(), "accession", "left")
    counted = marked.groupBy("file").agg(F.count("_done").alias("done"), F.count("accession").alias("total"))
    return counted.withColumn("pct", F.when(F.col("total") > 0, F.lit(100.0) * F.col("done") / F.col("total")).otherwise(F.lit(0.0)))


def overall(progress: DataFrame, chunks: DataFrame, done: DataFrame) -> DataFrame:
    """One row: distinct accessions done and remaining, and chunks full, partly done, not started;
    an empty chunk is both full and not started."""
    marked = chunks.select("accession").distinct().join(done.select("accession", F.lit(1).alias("_done")).distinct(), "accession", "left").agg(F.count("_done").alias("done"), F.count("accession").alias("total"))
    by_chunk = progress.agg(
        F.count(F.when(F.col("done") == F.col("total"), 1)).alias("full"),
        F.count(F.when((F.col("done") > 0) & (F.col("done") < F.col("total")), 1)).alias("partly"),
        F.count(F.when(F.col("done") == 0, 1)).alias("not_started"),
    )
    pct = F.when(F.col("total") > 0, F.lit(100.0) * F.col("done") / F.col("total")).otherwise(F.lit(0.0))
    return marked.join(F.broadcast(by_chunk)).select("done", (F.col("total") - F.col("done")).alias("remaining"), "total", pct.alias("pct"), "full", "partly", "not_started")


def progress_runs(progress: DataFrame, *order: str, block: int = ranges.BLOCK) -> DataFrame:
    """Runs of neighbouring chunks in the same bucket: (run, bucket, chunks, done, total, pct, label)."""
    settled = scratch(progress.withColumn("bucket", percent_bucket(F.col("pct"))), "progress")  # a row a file
    marked = numbered(settled, *order)
    found = ranges.runs(marked, "nth", F.col("bucket"), ("done", "total"), ("file",), block)
    chunks = F.col("end") - F.col("start") + 1
    label = F.when(chunks == 1, F.col("first_file")).otherwise(F.concat_ws(" .. ", "first_file", "last_file"))
    pct = F.when(F.col("total") > 0, F.lit(100.0) * F.col("done") / F.col("total")).otherwise(F.lit(0.0))
    return numbered(found, "start").select((F.col("nth") + 1).alias("run"), F.col("value").alias("bucket"), chunks.alias("chunks"), "done", "total", pct.alias("pct"), label.alias("label"))


def progress_histogram(progress: DataFrame) -> DataFrame:
    """(bin, n) of ten tens of percent, the last closed."""
    spine = progress.sparkSession.range(10).select(F.col("id").cast("int").alias("bin"))
    counted = progress.groupBy(F.least(F.floor(F.col("pct") / 10), F.lit(9)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counted, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def frequencies(rows: DataFrame) -> DataFrame:
    """(accession, n, first_source) of (accession, source, pos): the source of the first position."""
    return rows.groupBy("accession").agg(F.count(F.lit(1)).alias("n"), F.min_by("source", "pos").alias("first_source"))


def sweep(threads: DataFrame, lengths: DataFrame, reps: DataFrame) -> DataFrame:
    """Every setting of a benchmark: three short lists of settings."""
    return threads.crossJoin(lengths).crossJoin(reps)
