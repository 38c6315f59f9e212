import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from helixframe.llm import bpe

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(FILE)


def expected(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("which", ["odd", "documents", "none"])
def test_as_the_library(which, request):
    docs = request.getfixturevalue(which)
    got = bpe.encode(docs, FILE, decoded=True)
    want = sorted((str(r.doc_id), *map(str, expected(r.text))) for r in docs.collect())
    assert sorted((str(r.doc_id), str(list(r.ids)), r.decoded) for r in got.collect()) == want
    again = sorted((str(r.doc_id), r.decoded) for r in bpe.decode(got.drop("decoded"), FILE).collect())
    assert again == sorted((a, c) for a, _, c in want)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    import numpy as np

    codec = bpe.codec_of(FILE)
    ids = np.frombuffer(codec.encode(text), "<i4").tolist()
    assert (ids, codec.decode(ids)) == expected(text)


def test_tree_names_the_leftmost_least():
    rnd = random.Random(1)
    ranks = [rnd.randint(0, 5) for _ in range(37)]
    tree = bpe.SegmentTree(ranks)
    for _ in range(200):
        assert tree.leftmost() == ranks.index(min(ranks))
        i = rnd.randrange(37)
        ranks[i] = rnd.randint(0, 5)
        tree.put(i, ranks[i])


def test_query_digests(spark, small):
    from helixframe.llm.queries import op4_bpe

    rows = {r.doc_id: r for r in op4_bpe(spark, small).collect()}
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids, text = expected(r.text)
        assert rows[r.doc_id].n_tokens == len(ids)
        assert rows[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[r.doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_unknown_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, [39, 99_999_999, None]), (2, None), (3, []), (4, [200])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(rows, FILE).collect()}
    assert got == {1: LIBRARY.decode([39]), 2: "", 3: "", 4: LIBRARY.decode([200])}
