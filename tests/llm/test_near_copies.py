"""The pipeline's near-duplicate stage against all pairs of 5-word shingle sets."""

import random

import corpus_pipeline
import numpy as np

from helixframe.llm import simhash


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_dropped(rows):
    """Ids that are not the smallest of their component."""
    rows = sorted(rows)
    sets, root = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b) and top(i) != top(j):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {rows[i][0] for i in range(len(rows)) if top(i) != i}


def test_stage_drops_every_near_copy(spark):
    folder = "/root/testdata/sf0.01"
    docs = corpus_pipeline.drop_copies(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    rows = {r.doc_id: r.text for r in docs.collect()}
    want = brute_dropped(rows.items())
    after = corpus_pipeline.drop_near_copies(spark, docs, folder)
    assert after.columns == docs.columns
    assert len(want) == 5 and {r.doc_id for r in after.select("doc_id").collect()} == rows.keys() - want


def test_groups_and_chains(spark):
    rnd = random.Random(3)
    rows = []
    for size in (3, 8, 30, 60, 400):
        text = [f"w{rnd.randrange(10**6)}" for _ in range(size)]
        for step in range(24):  # a chain whose ends are not alike, around a centre with many copies
            rows.append((len(rows), " ".join(text)))
            edited = list(text)
            edited[rnd.randrange(size)] = f"x{len(rows)}"
            rows.append((len(rows), " ".join(edited)))
            for _ in range(max(1, size // 60)):
                text[rnd.randrange(size)] = f"y{rnd.randrange(10**6)}"
    rnd.shuffle(rows)
    want = brute_dropped(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for frequent in (simhash.FREQUENT, 5):  # how many shingles count as frequent decides no link
        found = simhash.near_copies(docs, frequent=frequent).collect()
        assert {int(r.key.split(":")[0]) for r in found if r.key != r.kept} == want


def test_sketches_never_show_more_than_differs():
    rng = np.random.default_rng(5)
    for n, m, common in ((1, 1, 1), (1, 2, 0), (64, 65, 60), (500, 600, 480), (1000, 1025, 900), (3000, 2600, 2500)):
        both = rng.integers(0, 2**64, n + m - common, dtype=np.uint64)
        a, b = (simhash.parity_sketch(np.unique(x)).view(np.uint64) for x in (both[:n], both[n - common :]))
        assert len(a) * 64 >= n > len(a) * 16 or len(a) == 1
        while len(a) != len(b):
            a, b = (x[: len(x) // 2] ^ x[len(x) // 2 :] if len(x) > len(y) else x for x, y in ((a, b), (b, a)))
        assert int(np.bitwise_count(a ^ b).sum()) <= n + m - 2 * common


def test_copies_shared_ids_and_texts_without_words(spark):
    base = [f"w{i}" for i in range(80)]
    rows = [(5, " ".join(base + ["end"])), (5, "quite another text of some words that nothing else here has"), (1, " ".join(base)), (None, " ".join(base)), (7, " ".join(base)), (8, None), (9, " \n"), (9, " \n")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, key string, node int")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, rows[2][1]), (5, rows[1][1]), (8, None)], key=str)
