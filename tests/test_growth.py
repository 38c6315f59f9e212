"""What is moved and made grows with the input, and results stay those of the plain way."""

import itertools
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helixframe import adapters
from helixframe.kernels.kmers import counted
from helixframe.operators import composition, kmers
from helixframe.plans import queries


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block", [3, 2000])
def test_scores_of_pairs_move_only_hits(spark, monkeypatch, block):
    monkeypatch.setattr(kmers, "BLOCK", block, raising=False)
    names = [f"p{k}" for k in range(25)]
    known = [("p1", "p9", 1e-4), ("p9", "p1", 1e-7), ("p9", "p9", 1e-90), ("p24", "p3", 20.0), ("p3", "p4", 1e-9), ("p0", "other", 1e-200), ("p7", "p8", None)]
    h = spark.createDataFrame(known, "query string, target string, evalue double")
    got = kmers.evalue_scores(spark.createDataFrame([(n,) for n in names], "seq_id string"), h, 10.0, 1e-300)
    rows = {(r.id_i, r.id_j): r for r in got.collect()}
    special = {("p1", "p9"): 7.0, ("p3", "p4"): 9.0}
    assert len(rows) == got.count() and set(rows) == set(itertools.combinations(sorted(names), 2))
    for pair, r in rows.items():
        want = special.get(pair, -1.0)
        assert (r.score, r.normalised, r.distance) == pytest.approx((want, want / 9, 1 - want / 9))
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def test_dominant_letter_makes_a_sequence_once(spark, small):
    got = composition.dominant_letter(adapters.sequences(spark, small), queries.DOMINANT)
    assert plan(got).count("regexp_replace") <= 2


def test_counts_by_kernel():
    texts = ["ACDACD", "", "AC", "A\0\0\0\0", "żółż😀ółż😀", "AAAA"]
    for k in (1, 2, 3, 5):
        row, nth, found, n = counted(texts, k)
        want = {(r, t[i : i + k]): c for r, t in enumerate(texts) for i, c in [(i, 0) for i in range(len(t) - k + 1)]}
        want = Counter((r, t[i : i + k]) for r, t in enumerate(texts) for i in range(len(t) - k + 1)) if want else {}
        assert {(int(r), found[i]): int(c) for r, i, c in zip(row, nth, n, strict=True)} == dict(want)


def test_counts_of_long_alphabets():
    text = "".join(map(chr, range(0x4E00, 0x4E00 + 3000))) * 2
    row, nth, found, n = counted([text], 9)
    assert len(found) == 3000 and sum(n) == len(text) - 8


def test_profiles_move_no_kmers_of_single_ids(spark, monkeypatch):
    monkeypatch.setattr(kmers, "CHARS", 5, raising=False)
    frame = spark.createDataFrame([("a", "ACDACD"), ("b", "AC"), ("c", "AAAAA"), ("r", "ACDA"), ("r", "ACD"), (None, "CCC"), (None, "CCC")], "seq_id string, seq string")
    rows = sorted((r.seq_id, r.kmer, r.n, round(r.freq, 6)) for r in kmers.profile(frame).collect())
    assert rows == [("a", "ACD", 2, 0.5), ("a", "CDA", 1, 0.25), ("a", "DAC", 1, 0.25), ("c", "AAA", 3, 1.0), ("r", "ACD", 2, 1.0), ("r", "ACD", 2, 2.0), ("r", "CDA", 1, 0.5), ("r", "CDA", 1, 1.0)]
    assert plan(kmers.profile(frame.filter("seq_id < 'd'"))).count("Generate") == 0


def test_features_of_repeated_ids(spark):
    frame = spark.createDataFrame([("a", "ACDACD"), ("r", "ACDA"), ("r", "ACD"), (None, "CCC")], "seq_id string, seq string")
    one = kmers.feature_counts(frame).first()
    assert (one.seqs, one.mean_features) == (4, pytest.approx(6 / 4))
    none = kmers.feature_counts(frame.limit(0)).first()
    assert none.seqs == 0 and none.mean_features is None


def test_samples_make_only_their_own_sequences(spark):
    ids = spark.range(200).select(F.concat(F.lit("S"), "id").alias("seq_id"), F.col("id").alias("pos"))
    first = {r.seq_id for r in ids.orderBy(F.md5("seq_id"), "seq_id").limit(5).collect()}
    bad = F.lit(1) / F.when(F.col("seq_id").isin(*first), 1).otherwise(0)  # fails for all rows but the five
    got = composition.sample(ids.withColumn("seq", bad.cast("string")), 5).collect()
    assert {r.seq_id for r in got} == first and math.isclose(float(got[0].seq), 1)
