"""Lines dropped by perfect hashing against plain counting."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from helixframe.llm import line_dedup, queries

BLANKS = " \t\n\x0b\x0c\r"
LINE = "A line that many documents share, of forty letters and more"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def plain(rows, least_docs=5, least_chars=40):
    having = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            having[key_of(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        holder = lambda k: max((d for d in having[k] if d is not None), default=None)
        kept = [x for x in lines if not (len(key_of(x)) >= least_chars and len(having[key_of(x)]) >= least_docs and holder(key_of(x)) != doc)]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def found(frame, **settings):
    return sorted((tuple(r) for r in queries.line_digest(frame, **settings).collect()), key=str)


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(i, f"{LINE}\nown line {i} of its document, which is long enough as well\n \t{LINE.upper()} \r\nshort") for i in range(30)]
    rows += [(40 + i, "é" * 39 + ("x" if i % 2 else "")) for i in range(12)] + [(60, LINE), (60, LINE + "\n"), (None, LINE), (None, "nobody has this line but rows without an id\n" + LINE)]
    rows += [(70 + i, "İ" + LINE) for i in range(4)] + [(80, "y" * 3_000_000 + "\n" + LINE + "\n" * 1000), (81, None), (82, ""), (83, "\n\n"), (84, "\n".join([LINE] * 50))]
    rows += [(90, "the same row many times over, long enough to be counted\n" + LINE)] * 200
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5).cache()


APART = {"broadcast_bytes": 0, "requests": 7}


@pytest.mark.parametrize("settings", [{}, APART])
@pytest.mark.parametrize("which", ["lines", "odd", "none", "documents"])
def test_against_counting(which, settings, request):
    frame = request.getfixturevalue(which)
    assert found(frame, **settings) == plain([(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()])


@pytest.mark.parametrize("settings", [{}, APART])
def test_other_thresholds_and_columns(lines, settings):
    frame = lines.selectExpr("doc_id", "text", "1 AS gone", "'r' AS row", "doc_id AS key", "text AS lost")
    out = line_dedup.drop_lines(frame, least_docs=2, least_chars=5, **settings)
    assert out.columns == frame.columns and out.count() == frame.count()
    want = {w[0]: w[3] for w in plain([(r.doc_id, r.text) for r in lines.collect()], 2, 5)}
    assert all(hashlib.sha256((r.text or "").encode()).hexdigest() == want[r.doc_id] for r in out.filter("doc_id IS NOT NULL AND doc_id <> 60").collect())
    assert found(lines, least_docs=1000, **settings) == plain([(r.doc_id, r.text) for r in lines.collect()], 1000)


def test_an_index_of_another_table(spark, lines):
    held = line_dedup.index(lines, shard_keys=1)
    assert held.shards >= 4 and held.bytes > 0
    other = spark.createDataFrame([(1000, f"{LINE}\nnew")], "doc_id long, text string")
    for settings in ({}, APART):
        assert line_dedup.drop_lines(other, held=held, **settings).collect()[0].text == "new"


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 1000, 200_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    h, g = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(2))
    h[: n // 2] = 5  # halves that are equal are told apart by the other ones
    made = line_dedup.PerfectHash.build(h, g)
    assert sorted(made.places(h, g)) == list(range(n)) and made.size == n
    assert sum(w.nbytes for w in made.levels) * 8 <= 64 * 20 + 4.5 * n
    assert made.places(g, h).max(initial=-1) < max(n, 1)
