"""Rows with a null id in the pipeline's stages."""

import corpus_pipeline

from helixframe.llm import secrets

SCHEMA = "doc_id long, text string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(100)]


def test_secrets_under_a_null_id_are_masked(spark):
    rows = [(None, "token=abcdefgh99 one", "a", 20), (None, "token=abcdefgh77 two", "b", 20), (None, "no secret", "b", 9), (1, "token=abcdefgh99 here", "a", 21)]
    got = {(r.doc_id, r.text, r.n_chars) for r in secrets.mask_live(spark.createDataFrame(rows, SCHEMA)).collect()}
    hidden = "token=[assign removed]"
    assert got == {(i, t, len(t)) for i, t in [(None, f"{hidden} one"), (None, f"{hidden} two"), (None, "no secret"), (1, f"{hidden} here")]}


def test_near_copies_under_a_null_id_are_dropped(spark):
    text, other = " ".join(WORDS), " ".join(reversed(WORDS))
    rows = [(i, t, "a", len(t)) for i, t in [(None, text + " x"), (10, text + " y"), (9, text + " z"), (None, other), (None, other + " x"), (None, "alone")]]
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, SCHEMA), "").collect()]
    assert (9, text + " z") in kept and (None, "alone") in kept and len(kept) == 3
    assert [t for i, t in kept if i is None and t.startswith(other)]
