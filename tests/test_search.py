"""Search against every pair scored in full."""

import random
from math import log

import pytest

from helixframe import adapters, cli
from helixframe.kernels import align
from helixframe.operators import distance
from helixframe.sources import tables

LETTERS = "ACDEFGHIKLMNPQRSTVWY"


def frame(spark, rows):
    return spark.createDataFrame(rows, "seq_id string, seq string")


def textbook(a, b, score, gap_open=10, gap_extend=1):
    low = -(10**9)
    h, e, f, best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], {}, {}, 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            e[i, j] = max(h[i - 1][j] - gap_open, e.get((i - 1, j), low) - gap_extend)
            f[i, j] = max(h[i][j - 1] - gap_open, f.get((i, j - 1), low) - gap_extend)
            h[i][j] = max(0, h[i - 1][j - 1] + score(a[i - 1], b[j - 1]), e[i, j], f[i, j])
            best = max(best, h[i][j])
    return best


def every_pair(queries, targets, evalue=10.0, table=None):
    """(query, target): score, of all pairs that pass."""
    letters, out = sum(len(s) for _, s in targets), {}
    for q, a in queries:
        for (t, _), score in zip(targets, align.pair_scores([a] * len(targets), [b for _, b in targets], table=table).tolist(), strict=True):
            if score and len(a) * letters * 2.0 ** -((distance.LAMBDA * score - log(distance.KAPPA)) / log(2)) <= evalue:
                out[q, t] = score
    return out


def scores(rows):
    return {(r.query, r.target): round((r.bits * log(2) + log(distance.KAPPA)) / distance.LAMBDA) for r in rows}


@pytest.fixture(scope="module")
def relatives():
    rnd = random.Random(3)
    rows = []
    for family in range(6):
        base = [rnd.choice(LETTERS) for _ in range(rnd.randrange(60, 140))]
        for member in range(5):
            seq = [c if rnd.random() > 0.06 * member else rnd.choice(LETTERS) for c in base]
            cut = rnd.randrange(10, 50)
            rows.append((f"f{family}m{member}", "".join(seq[:cut] + [rnd.choice(LETTERS) for _ in range(member)] + seq[cut + member % 3 :])))
    return rows + [("empty", ""), ("short", "AC"), ("runs", "A" * 90), ("half", "A" * 40 + "C" * 40)]


@pytest.mark.parametrize("table", [None, {a: {b: 4 if a == b else -2 for b in LETTERS} for a in LETTERS}])
def test_pairs_by_the_textbook(relatives, table):
    some = [s for _, s in relatives[::4]] + ["", "A"]
    first, second = zip(*[(a, b) for a in some for b in some], strict=True)
    rule = (lambda x, y: table[x][y]) if table else (lambda x, y: 2 if x == y else -1)
    want = [textbook(a, b, rule) for a, b in zip(first, second, strict=True)]
    assert align.pair_scores(list(first), list(second), table=table).tolist() == want
    found = align.pair_alignments(list(first), list(second), table=table)
    assert [h["score"] if h else 0 for h in found] == want
    for a, b, h in zip(first, second, found, strict=True):
        if h:
            assert h["identities"] + h["mismatch"] <= h["alnlen"] and h["qend"] - h["qstart"] + 1 <= h["alnlen"]
            assert align.local_alignment(a, b, table=table) == h


def test_diagonals_by_loops(relatives):
    some = [s for _, s in relatives[::3]]
    first, second = zip(*[(a, b) for a in some for b in some], strict=True)
    for seeds in (1, 2):
        got = align.diagonal_scores(list(first), list(second), 3, seeds, 12)
        for a, b, found in zip(first, second, got.tolist(), strict=True):
            best, lines = 0, {}
            for i in range(len(a) - 2):
                for j in range(len(b) - 2):
                    if a[i : i + 3] == b[j : j + 3]:
                        lines.setdefault(i - j, []).append(i)
            for d, places in lines.items():
                if seeds == 1 or any(1 <= y - x <= 12 for x in places for y in places):
                    sum_ = least = 0
                    for i in range(max(0, d), min(len(a), len(b) + d)):
                        sum_ += 2 if a[i] == b[i - d] else -1
                        best, least = max(best, sum_ - least), min(least, sum_)
            assert found == best


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_passages_as_in_every_pair(spark, folder):
    family = adapters.family(spark, folder)
    rows = [(r.seq_id, r.seq) for r in family.collect()]
    hits = distance.search(family).collect()
    assert scores(hits) == every_pair(rows, rows) and len(hits) == len({(r.query, r.target) for r in hits})


def test_relatives_and_the_exact_way(spark, relatives):
    seqs = frame(spark, relatives)
    want = every_pair(relatives, relatives)
    assert scores(distance.search(seqs, k=1, seeds=1, frequent=None, gaps=20).collect()) == want
    found = scores(distance.search(seqs).collect())
    assert found.items() <= want.items() and {p for p in want if p[0][:2] == p[1][:2]} <= found.keys()
    assert found["runs", "half"] == 80


def test_other_targets_and_the_best(spark, relatives):
    queries, targets = relatives[::5] + [("runs", "A" * 90)], relatives
    asked, held = frame(spark, queries), frame(spark, targets)
    exact = {"k": 1, "seeds": 1, "frequent": None, "gaps": 20}
    assert scores(distance.search(asked, held, **exact).collect()) == every_pair(queries, targets)
    table = {a: {b: 4 if a == b else -2 for b in LETTERS} for a in LETTERS}
    assert scores(distance.search(asked, held, table=table, **exact).collect()) == every_pair(queries, targets, table=table)
    for which, rows in ((None, relatives), (held, queries)):
        two = distance.search(frame(spark, rows), which, best=2).collect()
        by = {}
        for r in two:
            by.setdefault(r.query, set()).add(r.target)
        assert all(len(t) <= 2 and (q in t or q == "runs") for q, t in by.items()) and len(by) >= 6
    assert distance.search(asked.limit(0), held).count() == distance.search(asked, held.limit(0)).count() == 0


def test_frequent_words_are_no_seeds(spark):
    rows = [(f"s{i}", "ACDEFGHIKLMNPQRSTVWY" * 2) for i in range(6)]
    assert distance.search(frame(spark, rows), frequent=5).count() == 0 and distance.search(frame(spark, rows), frequent=6).count() == 36


def test_one_query_is_spread(spark, relatives):
    plan = distance.search(frame(spark, relatives), parts=7)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and plan.count("NestedLoop") == 1  # the one row with the size of the database
    assert "hashpartitioning(query" in plan and "target" in plan.split("hashpartitioning(query")[1].split(")")[0]


def test_search_command(spark, relatives, tmp_path, capsys):
    for name, rows in (("q.fasta", relatives[:3]), ("t.fasta", relatives)):
        (tmp_path / name).write_text("".join(f">{i} note\n{s}\n" for i, s in rows))
    cli.main(["search", str(tmp_path / "q.fasta"), "--targets", str(tmp_path / "t.fasta"), "--best", "3", "--evalue", "1e-3", "--output-dir", str(tmp_path / "hits")], spark)
    assert "queries" in capsys.readouterr().out
    found = tables.hit_table(spark, str(tmp_path / "hits")).collect()
    by = {}
    for r in found:
        by.setdefault(r.query, []).append(r.target)
    assert sorted(by) == ["f0m0", "f0m1", "f0m2"] and all(len(t) == 3 and q in t and all(x.startswith("f0") for x in t) for q, t in by.items())
