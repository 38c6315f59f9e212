import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helixframe.kernels import align, linkage, progressive, trees

SEQ = st.text("ACDE", max_size=14)


def slow_score(a, b):
    table = [[-2 * j for j in range(len(b) + 1)]]
    for i, x in enumerate(a, 1):
        row = [-2 * i]
        for j, y in enumerate(b, 1):
            row.append(max(table[-1][j - 1] + (1 if x == y else -1), table[-1][j] - 2, row[-1] - 2))
        table.append(row)
    return table[-1][-1]


@settings(max_examples=150, deadline=None)
@given(SEQ, SEQ)
def test_global_alignment(a, b):
    score = slow_score(a, b)
    assert align.global_score(a, b) == align.global_score(b, a) == score
    x, y = align.global_alignment(a, b)
    assert x.replace("-", "") == a and y.replace("-", "") == b and len(x) == len(y)
    assert sum(-2 if "-" in (p, q) else 1 if p == q else -1 for p, q in zip(x, y)) == score


@pytest.mark.parametrize("a,b,score,distance,rows", [("ACD", "AD", 0, 1.0, ("ACD", "A-D")), ("ACDEF", "ACEF", 2, 0.6, ("ACDEF", "AC-EF")), ("AAA", "CCC", -3, 2.0, ("AAA", "CCC")), ("AA", "A", -1, 1.5, ("AA", "-A"))])
def test_known_alignments(a, b, score, distance, rows):
    assert align.global_score(a, b) == score and align.distance(a, b) == distance and align.global_alignment(a, b) == rows


def slow_local(a, b, match=2, mismatch=-1, go=10, ge=1):
    low = -(10**9)
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    e = [[low] * (len(b) + 1) for _ in range(len(a) + 1)]
    f = [[low] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            e[i][j] = max(h[i - 1][j] - go, e[i - 1][j] - ge)
            f[i][j] = max(h[i][j - 1] - go, f[i][j - 1] - ge)
            h[i][j] = max(0, h[i - 1][j - 1] + (match if a[i - 1] == b[j - 1] else mismatch), e[i][j], f[i][j])
    return max(map(max, h))


@pytest.mark.parametrize("seed", range(60))
def test_local_alignment(seed):
    rnd = random.Random(seed)
    core = "".join(rnd.choice("ACDE") for _ in range(rnd.randint(0, 30)))
    a = core + "".join(rnd.choice("ACDE") for _ in range(rnd.randint(0, 8)))
    b = core[: len(core) // 2] + "".join(rnd.choice("FG") for _ in range(rnd.randint(0, 3))) + core[len(core) // 2 :]
    costs = rnd.choice([(10, 1), (3, 1), (2, 2)])
    best, hit = slow_local(a, b, go=costs[0], ge=costs[1]), align.local_alignment(a, b, gap_open=costs[0], gap_extend=costs[1])
    if best == 0:
        assert hit is None
        return
    assert hit["score"] == best
    gaps = hit["alnlen"] - hit["identities"] - hit["mismatch"]
    assert 2 * hit["identities"] - hit["mismatch"] - costs[0] * hit["gapopen"] - costs[1] * (gaps - hit["gapopen"]) == best
    assert hit["qend"] - hit["qstart"] + hit["tend"] - hit["tstart"] + 2 == 2 * (hit["identities"] + hit["mismatch"]) + gaps


D = np.array([[0, 5, 9, 9], [5, 0, 10, 10], [9, 10, 0, 8], [9, 10, 8, 0]], float)


def test_neighbour_joining():
    assert trees.neighbour_joining(D, list("ABCD")) == "((A:2.000000,B:3.000000):1.500000,(C:4.000000,D:4.000000):1.500000);"
    assert trees.neighbour_joining(D[:1, :1], ["A"]) == "A;"


def test_linkage_methods():
    assert linkage.linkage(D)[:, 2].tolist() == [5.0, 8.0, 9.5]
    assert linkage.linkage(D, "weighted")[-1, 2] == 9.5
    points = np.array([0.0, 1.0, 10.0, 11.0, 30.0])
    ward = linkage.linkage(np.abs(points[:, None] - points), "ward")
    assert ward[2, 2] == pytest.approx(np.sqrt(2 * 2 * 2 / 4) * 10)
    assert linkage.cut(ward, 5, 3) == [1, 1, 2, 2, 3] and linkage.cut(ward, 5, 9) == [1, 2, 3, 4, 5]
    assert linkage.newick(linkage.linkage(D), list("ABCD")).count(",") == 3
    assert linkage.last_merges(ward, 1)[0][3] == 5


def test_splits_are_named_from_one_side():
    merges = linkage.linkage(D)
    assert linkage.splits(merges, 4) == {(2, 3)}
    assert not linkage.splits(merges, 4) ^ linkage.splits(linkage.linkage(D, "weighted"), 4)


def test_parsimony_and_likelihood():
    merges = np.array([[0, 1, 0.2, 2], [2, 3, 0.4, 3]], float)
    assert trees.parsimony(merges, np.array([[1, 1], [2, 1], [1, 2]])).tolist() == [1, 1]
    same, other = trees.substitution(0.1)
    assert same == pytest.approx(0.905083245) and other == pytest.approx(0.004995619) and trees.substitution(0) == (1.0, 0.0)
    two = np.array([[0, 1, 0.1, 2]], float)
    got = trees.log_likelihood(two, np.array([[0, 0, -1], [0, 1, -1]]))
    assert got[0] == pytest.approx(-3.194610, abs=1e-6) and got[1] == pytest.approx(-7.653026, abs=1e-6) and got[2] == pytest.approx(0)
    assert list(trees.sampled_sites(1000)) == list(range(0, 1000, 5))


def test_progressive_alignment():
    seqs = ["ACDEFG", "ACDFG", "ACDEFGH", "CDEFG"]
    rows = progressive.progressive(seqs, linkage.linkage(np.abs(np.arange(4)[:, None] - np.arange(4)).astype(float)))
    assert [r.replace("-", "") for r in rows] == seqs and len({len(r) for r in rows}) == 1
    assert progressive.progressive([], []) == [] and progressive.progressive(["A"], []) == ["A"]
    with pytest.raises(ValueError):
        progressive.progressive(["A-C"], [])
