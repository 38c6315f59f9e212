"""The pipeline against a plain version of each stage, on the smallest tables."""

import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
from test_near_copies import brute_dropped
from tokenizers import Tokenizer

from helixframe.llm import secrets, toxicity


def test_stages_are_those_named():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "SimHash near-dedup", "secret scans", "packing"]


def test_each_stage(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    scorer = toxicity.Scorer(*toxicity.train(docs, labels))
    rows = {r.doc_id: r.text for r in docs.collect()}
    kept = {i: t for i, t in rows.items() if scorer.score(t) < 0.5}
    first = {}
    for i in sorted(kept):
        first.setdefault(kept[i] or "", i)
    kept = {i: kept[i] for i in first.values()}
    kept = {i: kept[i] for i in kept.keys() - brute_dropped(kept.items())}
    owners, repositories = defaultdict(set), defaultdict(set)
    source = {r.doc_id: r.source for r in docs.collect()}
    found = {i: (base := secrets.base_spans(t or "")) + secrets.further_spans(t or "", base) for i, t in kept.items()}
    for i, spans in found.items():
        for _, _, _, value in spans:
            owners[value].add(source[i])
            repositories[value].add(i)
    masked = {}
    for i, t in kept.items():
        out, at = [], 0
        for _, k, end, value in sorted(found[i], key=lambda s: s[2] - len(s[3])):
            if len(owners[value]) <= secrets.FEW_OWNERS and len(repositories[value]) <= secrets.FEW_REPOSITORIES and end - len(value) >= at:
                out += [t[at : end - len(value)], f"[{secrets.KINDS[k]} removed]"]
                at = end
        masked[i] = "".join([*out, (t or "")[at:]])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes() for i, t in masked.items()}

    stage_docs = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, stage_docs, small)
        assert after.columns == docs.columns, name
        stage_docs = after
    assert {r.doc_id: r.text or "" for r in stage_docs.collect()} == masked

    pieces = defaultdict(list)
    for p in corpus_pipeline.run(spark, small).collect():
        assert zlib.crc32(p.ids) == p.ids_crc32
        pieces[p.doc_id].append(p)
    assert {i: b"".join(p.ids for p in sorted(own, key=lambda p: p.start)) for i, own in pieces.items()} == want


def test_odd_rows_pass_every_stage_and_the_run(spark, odd, none, small, tmp_path):
    """Nulls, empty and very long texts, repeated rows and ids, clashing columns, and an empty table."""
    labels = spark.read.parquet(f"{small}/labels.parquet")
    for name, docs in (("odd", odd), ("none", none)):
        for stage, function in corpus_pipeline.STAGES[:-1]:
            after = function(spark, docs, small)
            assert after.columns == docs.columns, (name, stage)
            got, given = [(r.doc_id, r.text) for r in after.collect()], [(r.doc_id, r.text) for r in docs.collect()]
            if stage == "secret scans":
                assert sorted(str(i) for i, _ in got) == sorted(str(i) for i, _ in given)
                continue
            assert set(got) <= set(given)
            if stage == "exact dedup":
                assert sorted(t or "" for _, t in got) == sorted({t or "" for _, t in given})
        folder = tmp_path / name
        docs.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        pieces = corpus_pipeline.run(spark, str(folder)).collect()
        assert {p.doc_id for p in pieces} <= {r.doc_id for r in docs.collect()} and bool(pieces) == (name == "odd")
