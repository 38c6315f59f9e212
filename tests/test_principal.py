"""Components by Krylov passes against a dense decomposition."""

import numpy as np
import pytest

from helixframe import adapters
from helixframe.operators import composition, kmers, principal


def dense(rows, width):
    x = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        x[k, r["at"]] = r.x
    return x


def check(spark, features, ids, most, width):
    rows = principal.gathered(features, ids).orderBy("seq_id").collect()
    x = dense(rows, width)
    centred = x - x.mean(axis=0)
    u, s, _ = np.linalg.svd(centred, full_matrices=False)
    keep = min(most, int((s**2 > 1e-12).sum()))
    scores, shares = principal.components(features, ids, most, width)
    assert len(shares) == max(keep, 1)
    if not keep:
        assert shares["share"].tolist() == [0] and {tuple(r.scores) for r in scores.collect()} == {(0.0,)}
        return
    assert np.allclose(shares["share"], s[:keep] ** 2 / (s**2).sum(), atol=1e-7)
    got = np.array([r.scores for r in scores.orderBy("seq_id").collect()])
    apart = np.abs(np.diff(s[: keep + 1] ** 2)) if keep < len(s) else np.abs(np.diff(np.append(s[:keep] ** 2, 0)))
    for c in range(min(5, keep)):
        if apart[c] > 1e-6 and (c == 0 or apart[c - 1] > 1e-6):
            want = u[:, c] * s[c]
            want *= np.sign(want[np.abs(want).argmax()])
            assert np.allclose(np.abs(got[:, c]), np.abs(want), atol=1e-5) and got[np.abs(got[:, c]).argmax(), c] > 0
    again = got.T @ got
    assert np.allclose(again, np.diag(np.diag(again)), atol=1e-6 * again.max())


def test_random_rows(spark, monkeypatch):
    monkeypatch.setattr(principal, "RANGE", 7)
    rng = np.random.default_rng(0)
    x = rng.standard_normal((200, 30)) * (rng.random((200, 30)) < 0.4) * np.linspace(3, 0.1, 30)
    rows = [(f"r{i:03d}", j, float(x[i, j])) for i in range(200) for j in range(30) if x[i, j]]
    features = spark.createDataFrame(rows, "seq_id string, feature int, freq double").repartition(5)
    ids = spark.createDataFrame([(f"r{i:03d}",) for i in range(210)], "seq_id string").repartition(3)
    for most in (3, 50):
        check(spark, features, ids, most, 30)


@pytest.mark.parametrize("rows", [[], [("a", 1, 0.5)], [("a", 1, 0.5), ("b", 1, 0.5)], [("a", 0, 1.0), ("b", 2, 1.0), ("c", 2, 1.0)]])
def test_few_rows(spark, rows):
    features = spark.createDataFrame(rows, "seq_id string, feature int, freq double")
    ids = features.select("seq_id").distinct()
    if rows:
        check(spark, features, ids, 4, 3)
    else:
        assert principal.components(features, ids, 4, 3)[0].count() == 0


def test_words_of_the_table(spark):
    seqs = composition.sample(adapters.sequences(spark, "/root/testdata/sf0.01"), 400)
    check(spark, kmers.vectors(seqs), seqs, 50, 8000)


def test_no_rows_on_the_driver(spark):
    import inspect

    assert "toPandas" not in inspect.getsource(principal)
