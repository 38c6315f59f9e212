"""The manifest against a plain one, level by level over lists."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from helixframe.llm import merkle, queries

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def leaf(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """The last node, and the siblings of each leaf on its way."""
    ways, at = [""] * len(nodes), list(range(len(nodes)))
    while len(nodes) > 1:
        for k, n in enumerate(at):
            run = nodes[n // 8 * 8 : n // 8 * 8 + 8]
            ways[k] += "".join(run[: n % 8] + run[n % 8 + 1 :])
        at = [n // 8 for n in at]
        nodes = [h("".join(nodes[k : k + 8])) for k in range(0, len(nodes), 8)]
    return (nodes or [None])[0], ways


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r.lang, []).append(((-1 if r.doc_id is None else 0, r.doc_id or 0, leaf(r, r.text)), r))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        own = sorted(by[lang], key=lambda x: x[0])
        trees.append((own, *climb([k[2] for k, _ in own])))
    root, tops = climb([t[1] for t in trees])
    out = []
    for (own, subroot, ways), top in zip(trees, tops, strict=True):
        for (key, r), way in zip(own, ways, strict=True):
            changed = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.text is not None
            same = not changed or r.text == "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)
            out.append((r.doc_id, key[2], subroot, root, h(way + top), same))
    return out


def check(spark, frame):
    got = queries.manifest_digest(frame).collect()
    want = plain(frame.select(*FIELDS).collect())
    assert sorted((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) for r in got if r.doc_id is not None) == sorted(w for w in want if w[0] is not None)
    assert sorted(map(str, (tuple(r[:5]) + (r.verified,) for r in got))) == sorted(map(str, want))
    assert all((r.folded_root == r.root) == r.verified for r in got)


@pytest.mark.parametrize("which", ["odd", "none", "documents"])
def test_against_lists(which, spark, request):
    check(spark, request.getfixturevalue(which))


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (8,), (9, 1, 64), (65, 8, 7, 512), (513,), (3,) * 70 + (100,)])
def test_sizes(sizes, spark):
    rows = [(1000 * t + i, "s", f"l{t:03d}", i, f"Text {i}") for t, n in enumerate(sizes) for i in range(n)]
    random.Random(0).shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    want = {w[0]: w for w in plain(frame.collect())}
    got = merkle.manifest(frame, FIELDS, "lang", "doc_id", block_rows=17, fan=3)
    found = got.withColumn("proof_sha256", F.sha2("proof", 256)).collect()
    assert len(found) == len(rows) and all((r.id, r.leaf, r.subroot, r.root, r.proof_sha256, True) == (*want[r.id][:5], r.verified) for r in found)
    trees = len(sizes)
    for r in random.Random(1).sample(found, min(50, len(found))):
        assert merkle.fold(r.leaf, r.proof, r["size"], r.tree, r["index"], trees) == (r.subroot, r.root)
        assert r["index"] < r["size"] and merkle.fold(h("other"), r.proof, r["size"], r.tree, r["index"], trees)[1] != r.root


def test_repeated_rows_of_one_key(spark):
    frame = spark.createDataFrame([(5, "s", "en", 1, "same")] * 300 + [(i, "s", "en", 1, f"T{i}") for i in range(200)], "doc_id long, source string, lang string, n_chars long, text string")
    check(spark, frame)


def test_merging_is_associative():
    rng = random.Random(2)
    nodes = {(0, 0, i): h(str(i)) for i in range(300)}
    results = set()
    for _ in range(5):
        keys = list(nodes)
        rng.shuffle(keys)
        element = merkle.Element(1)
        while keys:
            part, keys = keys[:37], keys[37:]
            one = merkle.Element(1)
            one.add({k: nodes[k] for k in part}, {0: 300})
            element.add(one.nodes, one.sizes)
        results.add(tuple(element.nodes.items()))
    assert len(results) == 1 and list(results)[0][0][1] == climb(list(nodes.values()))[0]
