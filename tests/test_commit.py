"""Files are published together or not at all; finished work counts in any order of arrival."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from helixframe import sinks
from helixframe.sources import tables, text
from helixframe.streaming import completion


def chunks(spark, n, first=0):
    return spark.createDataFrame([(i // 4 + first, i, f"A{i:03d}") for i in range(n)], "chunk int, nth long, accession string").repartition(5)


def there(folder):
    return sorted(os.listdir(folder)) if os.path.isdir(folder) else None


def test_files_are_published_together(spark, tmp_path):
    sinks.write_chunks(chunks(spark, 10), str(tmp_path / "a" / "out"))
    assert [f for f in there(tmp_path / "a" / "out") if not f.startswith(".")] == ["chunk_01.txt", "chunk_02.txt", "chunk_03.txt"]
    assert there(tmp_path / "a") == ["out"]
    read = text.chunk_directory(spark, str(tmp_path / "a" / "out")).orderBy("file_number", "pos").collect()
    assert [r.accession for r in read] == [f"A{i:03d}" for i in range(10)]


@pytest.mark.parametrize("exists", [False, True])
def test_a_failed_task_leaves_nothing(spark, tmp_path, exists):
    target = tmp_path / "out"
    if exists:
        sinks.write_chunks(chunks(spark, 8, 10), str(target))
    before = there(target)
    bad = chunks(spark, 40).withColumn("accession", F.when(F.col("nth") == 33, F.raise_error(F.lit("no such accession"))).otherwise(F.col("accession")))
    with pytest.raises(Exception, match="no such accession"):
        sinks.write_chunks(bad, str(target))
    assert there(target) == before and there(tmp_path) == (["out"] if exists else [])


def test_nothing_is_overwritten_or_half_written(spark, tmp_path):
    target = tmp_path / "out"
    sinks.write_chunks(chunks(spark, 4, 2), str(target))  # chunk_03.txt
    before = {f: (target / f).read_bytes() for f in there(target)}
    with pytest.raises(OSError, match="chunk_03"):
        sinks.write_chunks(chunks(spark, 20), str(target))
    assert {f: (target / f).read_bytes() for f in there(target)} == before and there(tmp_path) == ["out"]
    sinks.write_chunks(chunks(spark, 4), str(target))  # another name joins what is there
    assert {"chunk_01.txt", "chunk_03.txt"} <= set(there(target))


@pytest.mark.parametrize("seed", [0, 1])
def test_feed_equals_the_batch_in_any_order(spark, tmp_path, seed):
    rnd, runs = random.Random(seed), tmp_path / "runs"
    made = [(f"task_{i}", [f"G{rnd.randrange(12)}" for _ in range(3)], 1_700_000_000 - 86_400 * 30 * i) for i in range(6)]
    rnd.shuffle(made)
    for k, (name, downloaded, seen) in enumerate(made):  # one trigger each, some a month or more behind
        (runs / name).mkdir(parents=True)
        file = runs / name / "metadata.json"
        file.write_text(json.dumps({"accession_file": "x", "assemblies_requested": downloaded, "assemblies_downloaded": downloaded, "num_sequences": 1, "three_di_fasta": "y"}))
        os.utime(file, (seen, seen))
        completion.write_completed(completion.completed_stream(spark, str(runs)), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
        got = sorted(r.accession for r in spark.read.parquet(str(tmp_path / "out")).collect())
        assert got == sorted({a for _, own, _ in made[: k + 1] for a in own})
    assert got == sorted(r.accession for r in tables.downloaded(tables.run_metadata(spark, str(runs))).select("accession").distinct().collect())
