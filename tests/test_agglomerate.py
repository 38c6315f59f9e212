"""Rounds of mutual nearest neighbours against one merge at a time."""

import numpy as np
import pytest

from helixframe import adapters
from helixframe.kernels import linkage
from helixframe.kernels import trees as kernel
from helixframe.operators import agglomerate, trees


def rows(spark, d):
    return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(d)], "node long, row array<double>").repartition(3)


def points(seed, n, kinds=None):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, kinds, (n, 2)).astype(float) if kinds else rng.standard_normal((n, 3))
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))


@pytest.mark.parametrize("method", ["average", "weighted", "ward"])
@pytest.mark.parametrize("last", [0, 9])
def test_as_one_at_a_time(spark, method, last):
    d = points(1, 40)
    want, got = linkage.linkage(d, method), agglomerate.agglomerate(rows(spark, d), method, last)
    assert np.array_equal(got[:, [0, 1, 3]], want[:, [0, 1, 3]]) and np.allclose(got[:, 2], want[:, 2], rtol=1e-12)


@pytest.mark.parametrize("method", ["average", "weighted"])
def test_ties(spark, method):
    rng = np.random.default_rng(2)
    d = rng.integers(1, 4, (14, 14)).astype(float)  # whole numbers and halves: equal distances stay equal
    d = np.minimum(d, d.T)
    d = 1 + d / 4 if method == "average" else d
    np.fill_diagonal(d, 0)
    method_rows = rows(spark, d)
    want = linkage.linkage(d, "weighted")
    got = agglomerate.agglomerate(method_rows, "weighted", 0)
    assert np.array_equal(got, want)


def test_equal_points(spark):
    d = points(3, 16, 2)
    want, got = linkage.linkage(d), agglomerate.agglomerate(rows(spark, d), "average", 0)
    assert np.array_equal(got[:12], want[:12]) and np.allclose(got[:, 2:], want[:, 2:])


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_few(spark, n):
    d = points(4, n) if n else np.zeros((0, 0))
    got = agglomerate.agglomerate(rows(spark, d), "ward", 0)
    assert np.allclose(got, linkage.linkage(d, "ward"))


def test_numbers_of_a_tree():
    d = points(5, 30)
    want = [tuple(m) for m in linkage.linkage(d).tolist()]
    shuffled = [(int(a), int(b), g, int(s)) for a, b, g, s in want]
    assert linkage.numbered(shuffled, 30)[0] == [(int(a), int(b), g, int(s)) for a, b, g, s in want]


@pytest.fixture(scope="module")
def family(spark):
    return adapters.family(spark, "/root/testdata/sf0.01")


@pytest.mark.parametrize("method", ["average", "weighted"])
def test_large_families_as_small_ones(spark, family, method):
    both = family.unionByName(family.limit(3).selectExpr("'few' AS family", "seq_id", "pos", "seq")).unionByName(spark.createDataFrame([("one", "x", 1, "ACD")], "family string, seq_id string, pos long, seq string"))
    want, got = ([tuple(r) for r in trees.merge_table(both, method, last).orderBy("family", "step").collect()] for last in (512, 5))
    assert [(w[:4], w[5]) for w in want] == [(g[:4], g[5]) for g in got] and np.allclose([w[4] for w in want], [g[4] for g in got], atol=1e-9)


def test_distances_as_in_the_kernel(spark, family):
    own = trees.in_order(family.unionByName(spark.createDataFrame([("all", "short", 10**6, "AC"), ("all", "none", 10**6 + 1, "")], "family string, seq_id string, pos long, seq string")))
    got = np.array([r.row for r in trees.distance_rows(own).orderBy("node").collect()])
    assert np.allclose(got, trees.profile_distances([r.seq for r in own.orderBy("row").collect()]), atol=1e-11)


def test_sites_as_in_the_kernel(spark, family):
    rows = [r.seq for r in trees.in_order(family).orderBy("row").collect()] + ["AC?", ""]
    more = spark.createDataFrame([("all", "odd", 10**6, "AC?"), ("all", "none", 10**6 + 1, ""), ("one", "x", 1, "ACD"), ("empty", "y", 1, "")], "family string, seq_id string, pos long, seq string")
    both = family.unionByName(more)
    length = int(np.median([len(r) for r in rows]))
    states = {c: i for i, c in enumerate("ACDEFGHIKLMNPQRSTVWY-")}
    numbers = np.array([[states.get(c, 21) for c in r[:length].ljust(length, "-")] for r in rows])
    for about, sites in ((200, list(kernel.sampled_sites(length))), (None, list(range(length))), (10, list(range(0, length, length // 10)))):
        got = {(r.family, r.topology): r for r in trees.tree_scores(both, about).collect()}
        assert len(got) == 6
        for topology, method in (("UPGMA", "average"), ("WPGMA", "weighted")):
            merges = linkage.linkage(trees.profile_distances(rows), method)
            r = got["all", topology]
            assert r.parsimony == kernel.parsimony(merges, np.int64(1) << numbers).sum()
            lnl = kernel.log_likelihood(merges, np.where(numbers < 20, numbers, -1)[:, sites]).sum() * length / len(sites)
            assert r.log_likelihood == pytest.approx(lnl, rel=1e-12)
            assert got["one", topology].parsimony == 0 and got["empty", topology].log_likelihood == 0


def test_texts_and_splits_of_large_families(spark, family):
    for method in ("average", "weighted"):
        assert trees.newick(family, method, 5).collect() == trees.newick(family, method).collect()
        assert sorted(trees.tree_splits(family, method, 5).collect()) == sorted(trees.tree_splits(family, method).collect())
