"""Blocks of numbers against plain loops, and plans without a window over all rows."""

import random

import pytest
from pyspark.sql import functions as F

from helixframe.operators import conservation, ranges, workqueue


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block", [1, 3, 7, 10_000])
@pytest.mark.parametrize("n", [0, 1, 25, 90])
def test_sliding(spark, n, block):
    rnd = random.Random(n)
    xs = [rnd.randrange(100) for _ in range(n)]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "col int, x int").repartition(3)
    got = {r.col: r.s for r in ranges.sliding(frame, "col", {"s": (F.col("x"), "sum")}, 5, 4, block).collect()}
    assert got == {i: sum(xs[max(0, i - 5) : i + 5]) for i in range(n)}


@pytest.mark.parametrize("block", [2, 3, 10, 10_000])
@pytest.mark.parametrize("seed", range(4))
def test_runs(spark, seed, block):
    rnd = random.Random(seed)
    rows = [(i, "ab"[rnd.random() < 0.2 + 0.3 * (seed % 2)], rnd.randrange(9), f"f{i}") for i in range(0 if seed == 3 else 120) if rnd.random() > 0.1 * seed]
    want, last = [], None
    for i, v, x, f in rows:
        if last and last[1] == i - 1 and last[2] == v:
            last[1], last[3], last[5] = i, last[3] + x, f
        else:
            want.append(last := [i, i, v, x, f, f])
    frame = spark.createDataFrame(rows, "at long, v string, x long, f string").repartition(3)
    got = ranges.runs(frame, "at", F.col("v"), ("x",), ("f",), block)
    assert sorted(map(list, got.collect())) == want and "SinglePartition" not in plan(got)


@pytest.mark.parametrize("width", [1, 4, 10_000])
def test_points_in_intervals(spark, width):
    points = spark.createDataFrame([(i,) for i in range(40)], "col int")
    spans = spark.createDataFrame([(0, 0, 0), (1, 3, 17), (2, 10, 11), (3, 39, 60)], "b int, start int, end int")
    got = ranges.within(points, "col", spans, "start", "end", width)
    assert sorted((r.col, r.b) for r in got.collect()) == sorted((i, b) for b, s, e in ((0, 0, 0), (1, 3, 17), (2, 10, 11), (3, 39, 60)) for i in range(40) if s <= i <= e)
    assert "NestedLoop" not in plan(got)


def test_plans_of_profiles_and_runs(spark):
    profile = spark.createDataFrame([(i, float(i % 5), 0.1, 0.0) for i in range(50)], "col int, h double, gap_frac double, kl double")
    smoothed = conservation.smooth(profile, "h", block=7)
    assert [(r.block, r.start, r.end, r.length) for r in conservation.blocks(smoothed, 1.9, 1, 0.5, 7).orderBy("block").collect()] == [(r.block, r.start, r.end, r.length) for r in conservation.blocks(conservation.smooth(profile, "h"), 1.9, 1, 0.5).orderBy("block").collect()]
    assert "SinglePartition" not in plan(smoothed)
    done = spark.createDataFrame([(f"c{i}", i, i // 3 % 2, 1, 100.0 * (i // 3 % 2)) for i in range(20)], "file string, n int, done int, total int, pct double")
    some, all_ = ([tuple(r) for r in workqueue.progress_runs(done, "n", "file", block=b).orderBy("run").collect()] for b in (4, 10_000))
    assert some == all_ and len(some) == 7 and some[0][-1] == "c0 .. c2"
