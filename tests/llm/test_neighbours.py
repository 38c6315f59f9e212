import numpy as np
import pytest

from helixframe.llm import neighbours, queries


def brute(rows, k=20):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for i in sorted({int(i) for i in ids if i % 20 == 0}):
        scores = x @ x[list(ids).index(i)]
        out[i] = sorted((-s, int(j)) for s, j in zip(scores, ids) if j != i)[:k]
    return out


def test_recall_on_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want, got = brute(rows), {}
    for r in queries.op9_neighbours(spark, folder).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert got.keys() == want.keys()
    exact = dict(rows)
    for q, near in got.items():
        assert sorted(near) == list(range(1, 21))
        scores = [near[i][1] for i in range(1, 21)]
        assert scores == sorted(scores, reverse=True)
        assert all(abs(s - np.dot(np.array(exact[q], float), np.array(exact[v], float))) < 1e-12 for v, s in near.values())
    recall = np.mean([len({v for v, _ in got[q].values()} & {j for _, j in want[q]}) / 20 for q in want])
    assert recall >= 0.9


def test_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((30, 4))
    rows = [(i, base[i % 30].tolist()) for i in range(120)] + [(200 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(100)]
    bad = [(400, None), (401, [0.0] * 4), (402, [1.0, None, 0.0, 0.0]), (403, [float("nan"), 1.0, 0.0, 0.0]), (404, [float("inf"), 1.0, 0.0, 0.0]), (None, [1.0, 1.0, 0.0, 0.0]), (405, [])]
    frame = spark.createDataFrame([(i, v, "x", 3) for i, v in rows + rows[:5] + bad], "vec_id long, embedding array<double>, score string, rank int")
    got = {}
    for r in neighbours.search(frame, lambda c: c % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(rows)
    assert got.keys() == want.keys()
    for q, near in got.items():
        assert [v for _, v, _ in sorted(near)] == [j for _, j in sorted((round(s, 9), j) for s, j in want[q])]


def test_vectors_of_several_lengths_are_searched_apart(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(4 if i % 3 else 6).tolist()) for i in range(200)] + [(300, [1.0, 2.0])]
    got = {}
    for r in neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda c: c % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for width in (4, 6):
        want = brute([(i, v) for i, v in rows if len(v) == width])
        assert {q: [v for _, v in sorted(got[q])] for q in want} == {q: [j for _, j in near] for q, near in want.items()}
    assert 300 not in got


@pytest.mark.parametrize("clustered", [False, True])
def test_recall_beyond_the_sample(spark, clustered):
    rng = np.random.default_rng(3)
    n = 12_000
    x = rng.standard_normal((n, 24)) + (4 * rng.standard_normal((300, 24))[rng.integers(0, 300, n)] if clustered else 0)
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want, got = brute(rows), {}
    for r in neighbours.search(frame, lambda c: c % 20 == 0, sample_rows=2048).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[q] & {j for _, j in want[q]}) / 20 for q in want]) >= 0.9


def test_probes_are_as_few_as_the_recall_asks_for():
    rng = np.random.default_rng(5)
    centres = 20 * rng.standard_normal((16, 12))
    x = centres[rng.integers(0, 16, 2000)] + rng.standard_normal((2000, 12))
    router = neighbours.fit(x[250:], 16)
    assert neighbours.probes_for(router, x[250:], x[:250], 20, 0.95) <= 6
    assert neighbours.probes_for(router, x[250:], x[:250], 20, 1.0) >= neighbours.probes_for(router, x[250:], x[:250], 20, 0.9)


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(0, [1.0, 2.0]), (1, [0.5, 0.5])]])
def test_few(spark, rows):
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), lambda c: c % 20 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == ([(0, 1, 1)] if len(rows) == 2 else [])


def test_parts_are_balanced():
    x = np.random.default_rng(4).standard_normal((500, 8))
    sizes = np.bincount(neighbours.balanced_parts(neighbours.neighbour_graph(x, 10), 8))
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 2
