import re
from collections import defaultdict

import pytest
import xxhash

from helixframe.llm import components, simhash


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(nodes, edges):
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    root = {}
    for n in sorted(nodes):
        todo = [n] if n not in root else []
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = n
                todo.extend(near[x])
    return root


def brute(rows):
    prints = [slow_fingerprint(t) for _, t in rows]
    edges = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    root = slow_components(range(len(rows)), edges)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root[i]].append(doc_id)
    return [(doc_id, f"{prints[i]:016x}", min(least[root[i]], default=None)) for i, (doc_id, _) in enumerate(rows)]


def key(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("which", ["odd", "documents", "none"])
def test_whole_result(which, request):
    docs = request.getfixturevalue(which)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert key(map(tuple, simhash.near_duplicates(docs).collect())) == key(brute(rows))


def test_links_are_complete_at_every_distance(spark):
    import random

    rnd = random.Random(5)
    prints = {rnd.getrandbits(64) for _ in range(300)} | {0, (1 << 64) - 1}
    for p in list(prints)[:120]:
        for n in (1, 2, 3, 4):
            x = p
            for b in rnd.sample(range(64), n):
                x ^= 1 << b
            prints.add(x)
    signed = {p - (1 << 64) if p >> 63 else p for p in prints}
    expected = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    got = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_components_of_a_path_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 300), (300, 301)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == slow_components({n for e in edges for n in e}, edges)


def test_long_text_counts_every_block():
    text = " ".join(str(i * i) for i in range(70_000))
    assert simhash.fingerprint(text) == slow_fingerprint(text)
