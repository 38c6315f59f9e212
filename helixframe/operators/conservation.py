"""Column profiles of an alignment (columns seq_id, row, aligned) and its conserved blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.functions.text import conservation, fit_length, letters
from helixframe.operators import ranges, workqueue
from helixframe.schemas import ALPHABET, ENTROPY_THRESHOLD, MAX_GAP_FRACTION, MIN_BLOCK_LENGTH, SMOOTHING_WINDOW

TINY = 1e-10


def pad_to_median(seqs: DataFrame) -> DataFrame:
    """(seq_id, row, aligned): every sequence cut or padded with gaps to the median length."""
    median = seqs.agg(F.floor(F.median(F.length("seq"))).cast("int").alias("_len"))
    return seqs.join(F.broadcast(median)).select("seq_id", F.col("pos").alias("row"), fit_length(F.col("seq"), F.col("_len")).alias("aligned"))


def cells(msa: DataFrame) -> DataFrame:
    """(row, col, ch), columns counted from 0."""
    return msa.select("row", F.posexplode(letters(F.col("aligned"))).alias("col", "ch"))


def column_counts(msa: DataFrame) -> DataFrame:
    """(col, ch, n, first_row)."""
    return cells(msa).groupBy("col", "ch").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first_row"))


def background(composition: DataFrame) -> DataFrame:
    """(ch, bg) of (ch, n): shares of the alphabet's letters, held above a tiny value."""
    own = composition.filter(F.col("ch").isin(*ALPHABET))
    return own.select("ch", F.greatest(F.col("n") / F.sum("n").over(W.partitionBy()), F.lit(TINY)).alias("bg"))


def column_profile(msa: DataFrame, bg: DataFrame) -> DataFrame:
    """(col, gap_frac, h, kl): entropy over the letters of a column and its divergence from a
    background; both null where a column holds gaps only."""
    counts = column_counts(msa)
    known = F.col("ch") != "-"
    columns = counts.groupBy("col").agg(F.sum("n").alias("rows"), F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("gaps"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("total"))
    letters_of = counts.filter(known)
    # bg holds a row per letter of the alphabet
    spine = columns.filter("total > 0").select("col", "total").join(F.broadcast(bg))
    filled = spine.join(letters_of.select("col", "ch", "n"), ["col", "ch"], "left").withColumn("p", F.coalesce(F.col("n"), F.lit(0)) / F.col("total"))
    held = F.greatest("p", F.lit(TINY))
    sums = filled.groupBy("col").agg(
        F.abs(F.sum(F.when(F.col("p") > 0, F.col("p") * F.log2("p")).otherwise(0.0))).alias("h"),
        F.sum(held).alias("s"),
        F.sum(held * F.log2(held / F.col("bg"))).alias("raw"),
    )
    # with q = held / s: sum q log2(q / bg) = raw / s - log2(s)
    kl = F.col("raw") / F.col("s") - F.log2("s")
    return columns.join(sums, "col", "left").select("col", (F.col("gaps") / F.col("rows")).alias("gap_frac"), "h", kl.alias("kl"))


def smooth(profile: DataFrame, column: str, window: int = SMOOTHING_WINDOW, shrink: bool = False, block: int = ranges.BLOCK) -> DataFrame:
    """profile with smooth_<column>: a centred mean, nulls as the largest entropy. Beyond the ends
    counts as zero; with shrink the mean is over what is there. Columns are numbered without gaps."""
    before, after = window // 2, window - window // 2 - 1
    filled, name = F.coalesce(F.col(column), F.log2(F.lit(20.0))), f"smooth_{column}"
    if shrink:
        return ranges.sliding(profile, "col", {name: (filled, "avg")}, before, after, block)
    return ranges.sliding(profile, "col", {name: (filled, "sum")}, before, after, block).withColumn(name, F.col(name) / window)


def blocks(profile: DataFrame, threshold: float = ENTROPY_THRESHOLD, shortest: int = MIN_BLOCK_LENGTH, most_gaps: float = MAX_GAP_FRACTION, block: int = ranges.BLOCK) -> DataFrame:
    """(block, start, end, length): runs of columns of low smoothed entropy and few gaps."""
    kept = profile.filter((F.col("smooth_h") < threshold) & (F.col("gap_frac") < most_gaps)).select("col")
    found = ranges.runs(kept, "col", F.lit(1), block=block).select("start", "end", (F.col("end") - F.col("start") + 1).alias("length")).filter(F.col("length") >= shortest)
    return workqueue.numbered(found, "start").select((F.col("nth") + 1).alias("block"), "start", "end", "length")


def consensus(msa: DataFrame) -> DataFrame:
    """(col, ch): the most frequent letter; ties go to the letter of the first row; else a gap."""
    best = F.max_by("ch", F.when(F.col("ch") != "-", F.struct("n", -F.col("first_row"))))
    return column_counts(msa).groupBy("col").agg(F.coalesce(best, F.lit("-")).alias("ch"))


def block_table(runs: DataFrame, profile: DataFrame, msa: DataFrame, width: int = 40) -> DataFrame:
    """Blocks with mean entropy, divergence and gaps (3 decimals) and their consensus."""
    joined = ranges.within(profile.join(consensus(msa), "col"), "col", runs, "start", "end")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("col", "ch"))), lambda x: x["ch"]), "")
    rows = joined.groupBy("block", "start", "end", "length").agg(F.round(F.avg("h"), 3).alias("mean_entropy"), F.round(F.avg("kl"), 3).alias("mean_kl"), F.round(F.avg("gap_frac"), 3).alias("gap_frac"), text.alias("text"))
    return rows.select("block", "start", "end", "length", "mean_entropy", "mean_kl", "gap_frac", F.concat(F.substring("text", 1, width), F.when(F.length("text") > width, "...").otherwise("")).alias("consensus"))


def coverage(runs: DataFrame, profile: DataFrame) -> DataFrame:
    """(conserved, columns, share)."""
    return runs.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("conserved")).join(F.broadcast(profile.agg(F.count(F.lit(1)).alias("columns")))).withColumn("share", F.col("conserved") / F.nullif("columns", F.lit(0)))


def column_summary(profile: DataFrame) -> DataFrame:
    return profile.agg(F.count(F.when(F.col("h") == 0, 1)).alias("perfect"), F.count(F.when(F.col("h") < 1.0, 1)).alias("under_one"), F.count("h").alias("valid"), F.min("h").alias("min_h"), F.max("h").alias("max_h"), F.avg("h").alias("mean_h"), F.median("h").alias("median_h"))


def residue_scores(msa: DataFrame, profile: DataFrame) -> DataFrame:
    """(seq_id, resi, col, score): conservation at each residue, residues counted from 0 without gaps."""
    placed = msa.select("seq_id", F.posexplode(letters(F.col("aligned"))).alias("col", "ch"))
    resi = F.sum(F.when(F.col("ch") != "-", 1).otherwise(0)).over(W.partitionBy("seq_id").orderBy("col")) - 1
    numbered = placed.withColumn("resi", resi).filter("ch <> '-'")
    scored = profile.select("col", conservation(F.coalesce(F.col("h"), F.log2(F.lit(20.0)))).alias("score"))
    return numbered.join(scored, "col").select("seq_id", "resi", "col", "score")
