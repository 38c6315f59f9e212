import numpy as np
import pytest

from helixframe.operators import reduce
from helixframe.plans import queries


def test_the_map_runs_the_steps_of_the_reference(spark, small, monkeypatch):
    asked, plain = [], reduce.tsne
    monkeypatch.setattr(reduce, "tsne", lambda x, *a, **k: asked.append(k.get("steps")) or plain(x, *a, **k))
    assert queries.tsne_map(spark, small).count() > 0 and asked == [1000]


@pytest.mark.parametrize("size", [15, 40])
@pytest.mark.parametrize("seed", range(10))
def test_clusters_settle_apart(seed, size):
    rng = np.random.default_rng(seed)
    y = reduce.tsne(np.vstack([rng.normal(0, 0.1, (size, 5)), rng.normal(8, 0.1, (size, 5))]), 5, 300, seed)
    one, other = y[:size], y[size:]
    gap = np.linalg.norm(one.mean(axis=0) - other.mean(axis=0))
    assert max(one.std(axis=0).max(), other.std(axis=0).max()) < 0.3 * gap
    assert one.std() + other.std() < gap
