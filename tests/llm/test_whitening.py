"""Whitening against dense linear algebra."""

from math import floor

import numpy as np
import pytest

from helixframe.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<double>"


def check(rows, got, most=32):
    """rows are those of one length that take part."""
    x = np.array([[floor(64 * c) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, d = x.shape
    sums = x.sum(axis=0)
    deviation = n * x - sums
    centred = np.array(deviation / n, float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    rank = min(most, int((values > values[0] * 1e-12).sum())) if values[0] > 0 else 0
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    assert sum(map(len, by.values())) == n * rank
    want = centred @ vectors[:, :rank] / np.sqrt(values[:rank])
    signs = np.ones(rank)
    first = {}
    for k, (i, _) in enumerate(rows):
        first.setdefault(i, k)
    for c in range(rank):
        at = int(np.abs(want[:, c]).argmax())
        i = rows[at][0]
        near = [r.whitened for r in by[i] if r.component == c + 1]
        signs[c] = np.sign(near[0]) * np.sign(want[at, c])
    for i, own in by.items():
        if sum(j == i for j, _ in rows) > 1:
            continue
        k = first[i]
        own = sorted(own, key=lambda r: r.component)
        assert [r.component for r in own] == list(range(1, rank + 1))
        assert all(r.n == n and r.deviation == sum(int(v) ** 2 for v in deviation[k]) for r in own)
        assert np.allclose([r.whitened for r in own], want[k] * signs, atol=1e-7)
        assert np.allclose([r.explained for r in own], values[:rank] / values.sum(), rtol=1e-8)
        assert all(r.identity_error <= 1e-9 for r in own)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_contract_on_whole_table(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = queries.op12_whitening(spark, folder)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(rows, found.collect())


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rng = np.random.default_rng(0)
    wide = [(i, (rng.standard_normal(6) * [9, 5, 3, 2, 1, 0.5]).tolist()) for i in range(300)]
    short = [(1000 + i, rng.standard_normal(3).tolist()) for i in range(50)]
    few = [(2000 + i, (5 * rng.standard_normal(40)).tolist()) for i in range(4)]
    again = [(3000, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])] * 5
    bad = [(1, None), (2, [1.0, None]), (3, [float("nan")] * 6), (4, [float("inf")] * 6), (5, []), (6, [7.5]), (8, [1.0] * 5), (9, [1.0] * 5), (None, [0.5] * 6)]
    rows = wide + short + few + again + bad
    frame = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, component string, n double").repartition(7)
    got = whitening.whiten(frame).collect()
    check(wide + again + [bad[-1]], [r for r in got if r.vec_id is None or r.vec_id < 1000 or r.vec_id == 3000])
    check(short, [r for r in got if r.vec_id is not None and 1000 <= r.vec_id < 2000])
    check(few, [r for r in got if r.vec_id is not None and 2000 <= r.vec_id < 3000])
    assert whitening.whiten(frame.limit(0)).count() == 0
    assert {r.component for r in whitening.whiten(frame, most=2).collect()} == {1, 2}


def test_rotations_give_small_values_exactly():
    rng = np.random.default_rng(1)
    u, _ = np.linalg.qr(rng.standard_normal((9, 9)))
    scaled = np.linalg.qr(rng.standard_normal((40, 9)))[0] * 10.0 ** -np.arange(0, 18, 2)
    values, vectors = whitening.jacobi(scaled)
    assert np.allclose(values, 10.0 ** -np.arange(0, 18, 2), rtol=1e-12) and np.allclose(vectors.T @ vectors, np.eye(9), atol=1e-14)
    values, vectors = whitening.jacobi(scaled @ u)
    assert np.allclose(values[:3], [1, 1e-2, 1e-4], rtol=1e-10)
    for shape in ((5, 5), (1, 7), (7, 1), (3, 8)):
        a = rng.standard_normal(shape)
        values, vectors = whitening.jacobi(a)
        assert np.allclose((vectors * values**2) @ vectors.T, a.T @ a)
    assert whitening.jacobi(np.zeros((2, 3)))[0].tolist() == [0, 0, 0]


def test_sums_beyond_a_long():
    big = np.array([[1 << 32, 1], [3, 4]], np.int64)
    assert whitening.squares(big) == [None, 25] and whitening.squares(big[1:]) == [25]
