import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helixframe.llm import exact_dedup
from helixframe.llm._common import keep_rows_not_in, maybe_in, membership_filter


def groups(docs):
    by = defaultdict(list)
    for r in docs.collect():
        by[r.text or ""].append(r.doc_id)
    return by


@pytest.mark.parametrize("which", ["odd", "documents", "none"])
@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_classes(which, keep, request):
    docs = request.getfixturevalue(which)
    got = exact_dedup.classify(docs, keep=keep).collect()
    expected = groups(docs)
    assert len(got) == sum(map(len, expected.values()))
    by = defaultdict(list)
    for r in got:
        by[r.digest].append(r)
    assert len(by) == len(expected)
    for text, ids in expected.items():
        rows = by[hashlib.sha256(text.encode()).hexdigest()]
        known = [i for i in ids if i is not None]
        best = (min if keep == "smallest" else max)(known, default=None)
        assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in rows)
        assert {r.keep_id for r in rows} == {best} and {r.group_size for r in rows} == {len(ids)}
        assert sum(r.kept for r in rows) == 1 and all(r.doc_id == best for r in rows if r.kept)


def test_weak_digests_are_told_apart_by_bytes(odd):
    weak = exact_dedup.classify(odd, digest=lambda t: F.lit("same"), second=lambda t: F.lit(1)).collect()
    sizes = sorted(len(v) for v in groups(odd).values() for _ in v)
    assert sorted(r.group_size for r in weak) == sizes and sum(r.kept for r in weak) == len(groups(odd))


WEAK = {"digest": lambda t: F.lit("same"), "second": lambda t: F.lit(1)}


def test_weak_digests_lose_no_row(spark):
    docs = spark.createDataFrame(list(enumerate(["aa", "aa", "bb", "bb", "cc"], 1)), "doc_id long, text string")
    assert sorted(r.doc_id for r in exact_dedup.deduplicate(docs, **WEAK).collect()) == [1, 3, 5]
    assert sorted(r.doc_id for r in exact_dedup.deduplicate(docs, keep="largest", **WEAK).collect()) == [2, 4, 5]


@pytest.mark.parametrize("settings", [{}, {"memtable_rows": 1}, {"memtable_rows": 2}, WEAK])
@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_a_second_table_enters_the_index(spark, odd, settings, keep):
    more = spark.createDataFrame([(-1, "a"), (50, "new"), (51, "new"), (-2, None), (3, ""), (None, "no id"), (60, "plain words here"), (61, "plain words here")], "doc_id long, text string").repartition(5)
    index = exact_dedup.Index(spark, keep=keep, **settings)
    index.add(odd)
    first = {(r.doc_id, r.kept) for r in index.classify().collect()}
    assert sum(k for _, k in first) == len(groups(odd))
    index.add(more)
    rows = [(r.doc_id, r.text or "") for r in odd.select("doc_id", "text").unionByName(more).collect()]
    best = {}
    for text in {t for _, t in rows}:
        ids = [i for i, t in rows if t == text and i is not None]
        best[text] = (min if keep == "smallest" else max)(ids, default=None)
    got = index.classify().collect()
    assert len(got) == len(rows) and sorted(str(r.doc_id) for r in got if r.kept) == sorted(map(str, best.values()))
    sizes = [sum(t == text for _, t in rows) for _, text in rows]
    assert sorted(r.group_size for r in got) == sorted(sizes)
    staying = [(r.doc_id, r.text or "") for r in index.deduplicate().collect()]
    assert sorted(staying, key=str) == sorted(((r.doc_id, r.text) for r in index.sources[-1].docs.fillna("").collect() if best[r.text] == r.doc_id and (r.doc_id, r.text) not in ([(None, "no id"), (3, "")] if keep == "smallest" else [])), key=str)


def test_runs_are_bounded_sorted_and_merged_without_an_exchange(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 1700).alias("text")).repartition(11)
    index = exact_dedup.index(docs, memtable_rows=60)
    assert len(index.runs()) > 1 and len(index.levels) > 2
    for run in index.runs():
        for rows in spark.table(run.name).select("digest").rdd.glom().collect():
            assert rows == sorted(rows)
    tables = [spark.table(r.name) for r in index.runs()]
    merged = index.merge(*tables[:2])
    assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
    entries = index.entries().collect()
    assert len(entries) == len({r.digest for r in entries}) == 1700 and sum(r.rows for r in entries) == 3000
    assert index.hits().count() == 1300


def test_deduplicate_keeps_whole_rows(odd):
    kept = exact_dedup.deduplicate(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sorted((r.text or "") for r in rows) == sorted(groups(odd))
    for r in rows:
        ids = [i for i in groups(odd)[r.text or ""] if i is not None]
        assert r.doc_id == min(ids, default=None)


def test_empty(none):
    assert exact_dedup.deduplicate(none).collect() == []


def test_filter_has_no_false_negatives(spark):
    keys = spark.range(0, 3000, 3).select(F.col("id").alias("k"))
    probed = maybe_in(spark.range(0, 3000), F.col("id"), membership_filter(keys, F.col("k"))).collect()
    assert all(r._maybe for r in probed if r.id % 3 == 0)
    assert sum(r._maybe for r in probed if r.id % 3) < 20


def test_keep_rows_not_in_keeps_columns_and_repeats(odd, spark):
    dropped = spark.createDataFrame([(0,), (8,), (77,)], "gone long")
    left = keep_rows_not_in(odd, F.col("doc_id"), dropped, "gone")
    assert left.columns == odd.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r.doc_id) for r in odd.collect() if r.doc_id not in (0, 8))
