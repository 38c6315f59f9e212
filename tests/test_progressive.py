"""Alignment in rounds of pieces against the kernel that merges row by row."""

import random

import numpy as np
import pytest

from helixframe import adapters
from helixframe.kernels import linkage
from helixframe.kernels import progressive as kernel
from helixframe.operators import progressive, trees


def tables(spark, families):
    rows = [(name, f"{name}{i}", i, s) for name, (own, _) in families.items() for i, s in enumerate(own)]
    merges = [(name, step, int(m[0]), int(m[1])) for name, (_, tree) in families.items() for step, m in enumerate(tree)]
    return spark.createDataFrame(rows, "family string, seq_id string, row long, seq string").repartition(3), spark.createDataFrame(merges, "family string, step long, left long, right long")


def relatives(seed, n):
    rnd = random.Random(seed)
    base = [rnd.choice("ACDEFGHIKL") for _ in range(40)]
    out = []
    for _ in range(n):
        own = [c if rnd.random() > 0.2 else rnd.choice("ACDEFGHIKL") for c in base]
        for _ in range(rnd.randrange(4)):
            own.insert(rnd.randrange(len(own)), rnd.choice("MNPQ"))
            del own[rnd.randrange(len(own))]
        out.append("".join(own[: rnd.randrange(25, 41)]))
    return out


def chain(n):
    return [(0, 1)] + [(k, n + k - 2) for k in range(2, n)]


@pytest.mark.parametrize("most", [1, 3, 64])
def test_as_row_by_row(spark, most):
    some = relatives(1, 23)
    families = {"clustered": (some, linkage.linkage(trees.profile_distances(some))), "chain": (relatives(2, 12), chain(12)), "two": (["ACD", "AD"], [(0, 1)]), "odd": (["", "AC", "", "É漢AC"], [(0, 2), (1, 3), (4, 5)]), "one": (["ACD"], [])}
    seqs, merges = tables(spark, families)
    got = {}
    for r in progressive.align_families(seqs, merges, most).collect():
        got.setdefault(r.family, {})[r.row] = r.aligned
    for name, (own, tree) in families.items():
        want = kernel.progressive(own, [(a, b, 0, 0) for a, b, *_ in tree])
        assert [got[name][i] for i in range(len(own))] == want


def test_family_of_the_table(spark, small):
    family = adapters.family(spark, small)
    ordered = family.orderBy("pos").collect()
    rows = [r.seq for r in ordered]
    want = kernel.progressive(rows, linkage.linkage(trees.profile_distances(rows)))
    got = {r.seq_id: r.aligned for r in trees.align_family(family).collect()}
    assert [got[r.seq_id] for r in ordered] == want


@pytest.mark.parametrize("most", [1, 2, 5, 64])
@pytest.mark.parametrize("n", [2, 3, 30, 200])
def test_pieces(n, most):
    rng = np.random.default_rng(n)
    for merges in (np.array(chain(n)), linkage.linkage(rng.random((n, n)) + 1)[:, :2].astype(int)):
        piece, turn = progressive.pieces(merges[:, 0], merges[:, 1], most)
        assert np.bincount(piece).max() <= most
        for step, (a, b) in enumerate(merges.tolist()):
            for child in (a, b):
                if child >= n:
                    assert piece[child - n] == piece[step] or turn[child - n] < turn[step]
        assert turn.max() <= len(set(piece.tolist()))
    assert progressive.pieces(np.array(chain(n))[:, 0], np.array(chain(n))[:, 1], most)[1].max() <= (n - 1) // max(1, most // 2) + 1


def test_several_tasks_a_round(spark):
    some = [s for seed in range(5) for s in relatives(seed, 15)]
    tree = linkage.linkage(trees.profile_distances(some))
    piece, turn = progressive.pieces(tree[:, 0].astype(int), tree[:, 1].astype(int), 8)
    assert len(set(piece[turn == 0].tolist())) > 3
