"""Length, composition and entropy of sequences (columns seq_id, seq)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.functions.text import distinct_letters, foreign_letters, letters
from helixframe.schemas import ALPHABET
from helixframe.storage import scratch


def length_summary(seqs: DataFrame) -> DataFrame:
    n = F.length("seq")
    return seqs.agg(F.count(F.lit(1)).alias("n"), F.min(n).alias("min_len"), F.max(n).alias("max_len"), F.avg(n).alias("mean_len"), F.median(n).alias("median_len"), F.stddev_pop(n).alias("std_len"))


def box(values: DataFrame, column: str) -> DataFrame:
    """Quartiles, the whiskers at 1.5 times the range between them, and outliers beyond."""
    q = values.agg(F.percentile(column, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    edges = q.select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("q2"), F.col("q")[2].alias("q3"))
    low, high = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")), F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    x, inside = F.col(column), (F.col(column) >= low) & (F.col(column) <= high)
    # edges is an aggregate without keys: one row by construction
    return values.join(F.broadcast(edges)).groupBy("q1", "q2", "q3").agg(F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"), F.count(F.when(~inside, 1)).alias("outliers"))


def histogram(values: DataFrame, column: str, bins: int, low: float | None = None, high: float | None = None) -> DataFrame:
    """(bin, lo, hi, n) over equal widths, the last bin closed; empty bins are listed. Bounds that
    are not given are the smallest and largest value."""
    # The values are needed twice, for their bounds and for their bins: they are computed once.
    x, settled = F.col("_x"), scratch(values.select(F.col(column).cast("double").alias("_x")), "histogram")
    bounds = settled.agg((F.lit(low) if low is not None else F.min(x)).cast("double").alias("lo"), (F.lit(high) if high is not None else F.max(x)).cast("double").alias("hi"))
    place = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((x - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins) + 1, F.lit(bins))).otherwise(1)
    counted = settled.join(F.broadcast(bounds)).filter(x.between(F.col("lo"), F.col("hi"))).groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (F.col("hi") - F.col("lo")) / bins
    spine = bounds.select("lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    return spine.join(counted, "bin", "left").select("bin", (F.col("lo") + (F.col("bin") - 1) * width).alias("lo"), (F.col("lo") + F.col("bin") * width).alias("hi"), F.coalesce("n", F.lit(0)).alias("n"))


def complexity_flags(seqs: DataFrame) -> DataFrame:
    return seqs.agg(F.count(F.when(F.length("seq") < 5, 1)).alias("very_short"), F.count(F.when(distinct_letters(F.col("seq")) <= 2, 1)).alias("low_complexity"), F.count(F.lit(1)).alias("n"))


def _of_letter(letter: str) -> Column:
    """How often a letter occurs, without an explode."""
    return F.length("seq") - F.length(F.replace(F.col("seq"), F.lit(letter), F.lit("")))


def global_composition(seqs: DataFrame) -> DataFrame:
    """(ch, n, pct) of the alphabet's letters, zero counts included: twenty sums in one pass."""
    sums = seqs.agg(*[F.coalesce(F.sum(_of_letter(c)), F.lit(0)).alias(c) for c in ALPHABET])
    rows = sums.select(F.explode(F.array(*[F.struct(F.lit(c).alias("ch"), F.col(c).cast("long").alias("n")) for c in ALPHABET])).alias("r")).select("r.ch", "r.n")
    return rows.withColumn("pct", F.when(F.sum("n").over(W.partitionBy()) > 0, F.lit(100.0) * F.col("n") / F.sum("n").over(W.partitionBy())))


def _own_letters() -> Column:
    """(ch, n) of the different letters of a sequence: a row of the corpus gives some dozen, not one
    for each of its letters."""
    return F.transform(F.array_distinct(letters(F.col("seq"))), lambda ch: F.struct(ch.alias("ch"), (F.length("seq") - F.length(F.replace(F.col("seq"), ch, F.lit("")))).cast("long").alias("n")))


def letter_usage(seqs: DataFrame) -> DataFrame:
    """(ch, n, pct) of all letters that occur."""
    rows = seqs.select(F.explode(_own_letters()).alias("c")).groupBy(F.col("c.ch").alias("ch")).agg(F.sum("c.n").alias("n"))
    return rows.withColumn("pct", F.lit(100.0) * F.col("n") / F.sum("n").over(W.partitionBy()))


def composition_matrix(seqs: DataFrame) -> DataFrame:
    """seq_id and the share of each letter of the alphabet; null for an empty sequence."""
    return seqs.select("seq_id", *[(_of_letter(c) / F.nullif(F.length("seq"), F.lit(0))).alias(f"f_{c}") for c in ALPHABET])


def composition_cells(seqs: DataFrame, n: int) -> DataFrame:
    """(row, col, ch, value): the cells of a heat map of a sample, a row for each sequence in order of
    position and a column for each letter of the alphabet; an empty sequence has zeros."""
    picked = sample(seqs, n)
    nth = F.row_number().over(W.partitionBy(F.lit(0)).orderBy("pos", "seq_id")) - 1  # as few rows as a picture has
    cells = F.array(*[F.struct(F.lit(k).cast("long").alias("col"), F.lit(c).alias("ch"), F.coalesce(_of_letter(c) / F.nullif(F.length("seq"), F.lit(0)), F.lit(0.0)).alias("value")) for k, c in enumerate(ALPHABET)])
    return picked.withColumn("row", nth.cast("long")).select("row", F.explode(cells).alias("x")).select("row", "x.*")


def matrix_cells(pairs: DataFrame, ids: DataFrame, value: str) -> DataFrame:
    """(row, col, value): the cells of a heat map of distances (id_i, id_j, value) of a sample: both
    halves and the diagonal, rows and columns in the order of the ids."""
    nth = F.row_number().over(W.partitionBy(F.lit(0)).orderBy("seq_id")) - 1  # as few rows as a picture has
    placed = ids.select("seq_id", nth.cast("long").alias("nth"))
    low, high = placed.select(F.col("seq_id").alias("id_i"), F.col("nth").alias("i")), placed.select(F.col("seq_id").alias("id_j"), F.col("nth").alias("j"))
    half = pairs.join(low, "id_i").join(high, "id_j").select("i", "j", F.col(value).alias("value"))
    whole = half.unionByName(half.select(F.col("j").alias("i"), F.col("i").alias("j"), "value")).unionByName(placed.select(F.col("nth").alias("i"), F.col("nth").alias("j"), F.lit(0.0).alias("value")))
    return whole.select(F.col("i").alias("row"), F.col("j").alias("col"), "value")


def entropy(seqs: DataFrame) -> DataFrame:
    """(seq_id, entropy): letters outside the alphabet count in the total, not in the sum. The counts
    are columns of their own, so that each letter is counted once for the terms it is in."""
    counted = seqs.select("seq_id", F.nullif(F.length("seq"), F.lit(0)).alias("_length"), *[_of_letter(c).alias(f"_{c}") for c in ALPHABET])
    share = {c: F.col(f"_{c}") / F.col("_length") for c in ALPHABET}
    total = sum((F.when(F.col(f"_{c}") > 0, p * F.log2(p)).otherwise(0.0) for c, p in share.items()), F.lit(0.0))
    return counted.select("seq_id", F.when(F.col("_length").isNotNull(), F.abs(total)).alias("entropy"))


def entropy_all_letters(seqs: DataFrame) -> DataFrame:
    """(seq_id, entropy) over all letters of each row; an empty sequence has 0."""
    n = F.length("seq")
    parts = F.transform(_own_letters(), lambda c: c["n"] * F.log2(c["n"]))
    total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
    return seqs.select("seq_id", F.when(n > 0, F.abs(F.log2(F.nullif(n, F.lit(0))) - total / n)).otherwise(0.0).alias("entropy"))


def entropy_summary(entropies: DataFrame) -> DataFrame:
    return entropies.agg(F.min("entropy").alias("min_h"), F.max("entropy").alias("max_h"), F.avg("entropy").alias("mean_h"), F.median("entropy").alias("median_h"), F.log2(F.lit(20.0)).alias("max_possible"))


def bad_letters(seqs: DataFrame) -> DataFrame:
    return seqs.select("seq_id", foreign_letters(F.col("seq")).alias("bad")).filter("bad <> ''")


def dominant_letter(seqs: DataFrame, above: float = 0.9) -> DataFrame:
    """(seq_id, ch, share) where one letter has more than a share; ties go to the first letter. A sequence
    is bound once: a filter behind a projection would be pushed down, and make it anew for each letter."""

    def told(seq: Column) -> Column:
        counts = F.array(*[F.struct((F.length(seq) - F.length(F.replace(seq, F.lit(c), F.lit("")))).alias("n"), F.lit(-i).alias("order"), F.lit(c).alias("ch")) for i, c in enumerate(ALPHABET)])
        return F.struct(F.array_max(counts).alias("best"), F.length(seq).alias("len"))

    bests = F.transform(F.filter(F.array("seq"), lambda seq: seq != ""), told)
    shares = F.transform(bests, lambda x: F.struct(x["best"]["ch"].alias("ch"), (x["best"]["n"] / x["len"]).alias("share")))
    return seqs.select("seq_id", F.inline(F.filter(shares, lambda x: x["share"] > above)))


def validate_pairs(residues: DataFrame, structures: DataFrame) -> DataFrame:
    """(seq_id, status) of residue sequences without a structure sequence, or of another length."""
    other = structures.select("seq_id", F.length("seq").alias("other_len"))
    joined = residues.select("seq_id", F.length("seq").alias("len")).join(other, "seq_id", "left")
    status = F.when(F.col("other_len").isNull(), "MISSING").when(F.col("len") != F.col("other_len"), "LENGTH MISMATCH")
    return joined.select("seq_id", "len", "other_len", status.alias("status")).filter("status IS NOT NULL")


def fasta_stats(seqs: DataFrame, *by: str) -> DataFrame:
    return seqs.groupBy(*by).agg(F.count(F.lit(1)).alias("proteins"), F.coalesce(F.sum(F.length("seq")), F.lit(0)).alias("residues"))


def sample(seqs: DataFrame, n: int) -> DataFrame:
    """n rows, the first by md5 of the id: the same rows at any partitioning. Order by pos after. The
    ids are picked first, so that only the sequences of these are made and moved; the rows are settled."""
    order = F.md5(F.col("seq_id")), F.col("seq_id")
    picked = scratch(seqs.select("seq_id").orderBy(*order).limit(n).distinct().withColumnRenamed("seq_id", "_id"), "sample-ids")
    found = seqs.join(F.broadcast(picked), F.col("seq_id").eqNullSafe(F.col("_id")), "left_semi")  # n ids at most
    return scratch(found.orderBy(*order).limit(n), "sample")


def lookup(structures: DataFrame, residues: DataFrame, seq_id: str) -> DataFrame:
    """Both sequences of an id, with a text in place of a missing residue sequence."""
    own = structures.filter(F.col("seq_id") == seq_id)
    other = residues.filter(F.col("seq_id") == seq_id).select("seq_id", F.col("seq").alias("aa"))
    return own.join(other, "seq_id", "left").select("seq_id", F.col("seq").alias("structure"), F.coalesce("aa", F.lit("(not found in combined AA FASTA)")).alias("aa"), F.length("aa").alias("aa_len"), F.length("seq").alias("structure_len"))


def similar_ids(seqs: DataFrame, part: str, most: int = 10) -> DataFrame:
    """Ids that hold a text, the first in file order."""
    return seqs.filter(F.col("seq_id").contains(part)).orderBy("pos", "seq_id").limit(most).select("pos", "seq_id")
