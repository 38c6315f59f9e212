import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from helixframe.llm import sharding


def slow_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & (1 << 64) - 1
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_as_published():
    keys = np.random.default_rng(0).integers(-(1 << 63), 1 << 63, 500)
    for shards in (1, 2, 7, 40, 41, 1000):
        assert sharding.jump(keys, shards).tolist() == [slow_jump(int(k) & (1 << 64) - 1, shards) for k in keys]


@pytest.mark.parametrize("which", ["odd", "documents", "none"])
def test_law_and_slots(which, request):
    docs = request.getfixturevalue(which)
    rows = sharding.shard(docs, 40).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots, shard_of = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        shard_of[r.doc_id].add((r.shard, r.grown_shard))
        assert r.grown_shard in (r.shard, 40) and 0 <= r.shard < 40
    assert all(len(s) == 1 for s in shard_of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_slots_over_many_blocks(documents, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BLOCK", 2)
    slots = defaultdict(list)
    for r in sharding.shard(documents, 5).collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_growth_moves_the_needed_share():
    keys = np.arange(40_000).astype(np.int64) * 0x9E3779B97F4A7C1 % (1 << 62)
    now, grown = sharding.jump(keys, 40), sharding.jump(keys, 41)
    assert set(grown[now != grown]) == {40} and 0.02 < (now != grown).mean() < 0.03
    assert np.bincount(now).max() < 1.2 * 1000


def test_one_key_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BLOCK", 2)
    rows = [(None if i % 2 else 7, f"text {i % 3}", i) for i in range(400)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, block long").repartition(4), 5).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert len(got) == 400 and len({r.shard for r in got if r.doc_id is None}) == 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter((r.doc_id, r.text_crc32) for r in got) == Counter((d, zlib.crc32(t.encode())) for d, t, _ in rows)
