"""Toxicity and language: held-out accuracy, and the forward algorithm against all segmentations."""

import math
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from helixframe.llm import language, queries, toxicity
from helixframe.llm._common import bounded_sample

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def tiny_model():
    texts = ["you are a loser. the sky is blue", "what a fine day. it rains", "the loserish one came. yes", "a blue sky over the sea", "losers all. no"] * 8
    return toxicity.fit(texts, [1, 0, 1, 0, 1] * 8)


def test_sentences_are_located(spark, tiny_model):
    docs = spark.createDataFrame([(1, "The sea is blue. You loser! It rains."), (2, "The sea is blue."), (3, None)], "doc_id long, text string")
    found = toxicity.locate(docs, tiny_model).collect()
    assert [(r.doc_id, "The sea is blue. You loser! It rains."[r.start : r.end].strip()) for r in found] == [(1, "You loser")]


@pytest.mark.parametrize("which", ["odd", "none"])
def test_every_row_is_scored(which, request, tiny_model):
    docs = request.getfixturevalue(which)
    rows = toxicity.score(docs, tiny_model).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in docs.collect())
    assert all(0 <= r.score <= 1 for r in rows)
    assert toxicity.keep_clean(docs, tiny_model).columns == docs.columns


def test_noisy_or():
    scorer = toxicity.Scorer(np.zeros(toxicity.DIMENSIONS, np.float32), 0.0)
    assert scorer.score("one two. three! four?") == pytest.approx(1 - 0.5**3)
    assert scorer.score("") == scorer.score(None) == scorer.score(" .. ") == 0


def test_without_both_labels(spark, odd, none):
    labels = spark.createDataFrame([(i, 0) for i in range(10)], "doc_id long, toxic int")
    assert all(r.score < 1e-6 for r in toxicity.score(odd, toxicity.train(odd, labels)).collect())
    assert toxicity.train(none, labels.limit(0))[1] == -30


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries.op6_toxicity(spark, folder).collect()}
    labels = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if held_out(r.doc_id)]
    assert all(got[r.doc_id].held_out for r in labels)
    hit = [got[r.doc_id].predicted == r.toxic for r in labels]
    clean = [got[r.doc_id].predicted for r in labels if r.toxic == 0]
    assert np.mean(hit) > 0.96 and np.mean(clean) < 0.02


def test_forward_sums_all_segmentations():
    known = {"▁": 0, "a": 1, "b": 2, "ab": 3, "▁a": 4, "ba": 5, "aba": 6, "bab": -1}
    table = np.random.default_rng(2).random((8, 3)) + 0.1
    known |= {p[:n]: -1 for p in list(known) for n in range(1, len(p)) if p[:n] not in known}

    def total(rest):
        if not rest:
            return np.ones(3)
        out = sum(table[i] * total(rest[len(p) :]) for p, i in known.items() if i >= 0 and rest.startswith(p))
        return out + (table[7] * total(rest[1:]) if known.get(rest[0], -1) < 0 else 0)

    words = ["a", "abab", "bb", "xab", "ababa", "b"]
    lattice = language.Lattice(words, known, 7)
    assert np.allclose(lattice.likelihood(table), [total("▁" + w) for w in words])
    weight = np.ones((len(words), 3))
    uses, step = lattice.expected(table, weight), 1e-6
    for i in range(8):  # expected uses are the derivative of the log-likelihood by log probability
        more = table.copy()
        more[i] *= 1 + step
        assert np.allclose((np.log(lattice.likelihood(more)) - np.log(lattice.likelihood(table))).sum(axis=0) / step, uses[i], atol=1e-3)


def test_long_words_agree():
    model = language.fit(["hallo welt strasse", "hello world street"], ["de", "en"], PIECES)
    scorer = language.Scorer(model)
    for word in ("hello", "strassenbahn"):
        scorer.learn_batch([[word]])
        assert np.allclose(scorer.values[scorer.index[word]], scorer.long_word(word))
    assert np.isfinite(scorer.long_word("x" * 5000)).all()
    known, table = language.vocabulary(PIECES), model.table
    for word in ("hello", "strassenbahn"):
        weight, uses = np.array([2.0, 0.0]), np.zeros_like(table)
        language.long_uses(word, known, table, uses, weight)
        assert np.allclose(uses, language.Lattice([word], known, len(table) - 1).expected(table, weight[None, :]))


def test_languages_without_spaces_are_learned():
    a, b = "abcdefghij" * 5, "jihgfedcba" * 5
    model = language.fit([a, b] * 4, ["xx", "yy"] * 4, PIECES)
    assert [x for x, _ in language.Scorer(model).scores([a + a, b + b])] == ["xx", "yy"]


@pytest.mark.parametrize("text", ["½ ¼", "½ ¼ ¾ ⅓ ⅔", "² ³ ¹ ² ³ ¹", "1 2 3 4 5", "_ _ _ _ _", "… — ! ?"])
def test_without_a_letter_undetermined(text):
    model = language.fit(["hallo welt strasse", "hello world street"], ["de", "en"], PIECES)
    assert language.Scorer(model).scores([text, None, "", text + " a"])[:3] == [("und", 0.0)] * 3
    assert language.Scorer(model).scores([text + " hello"])[0][0] == "en"


def test_slices_of_a_very_long_text_add_up(monkeypatch):
    model = language.fit(["hallo welt strasse", "hello world street"], ["de", "en"], PIECES)
    texts = ["hello wide world of streets " * 9, "hallo weite welt " * 7, "", "a hello"]
    want = language.Scorer(model).scores(texts)
    monkeypatch.setattr(language, "_AT_ONCE", 5)
    got = language.Scorer(model).scores(texts)
    assert [x for x, _ in got] == [x for x, _ in want] and np.allclose([p for _, p in got], [p for _, p in want])


def test_samples_are_bounded_and_whole(spark):
    rows = [(i, "word " * 50, 0) for i in range(60)] + [(7, "word " * 50, 0)] * 300 + [(100, "long " * 40_000, 1)]
    docs = spark.createDataFrame(rows, "_id long, _text string, _label int")
    found = bounded_sample(docs, 10**7)
    assert len(found) == 61 and max(len(t) for t, _ in found) == 200_000
    assert sum(len(t) for t, _ in bounded_sample(docs, 5000)) <= 5000


def test_score_by_plain_arithmetic(spark, tiny_model):
    weights, bias = tiny_model
    text = "The sea is blue. You LOSER of losers! It rains. Ein Satz ohne Ende"
    chance, at, places = 1.0, 0, []
    for sentence in re.split("([.!?])", text)[::2]:
        z = bias
        for word in re.findall("[a-z]+", sentence.lower()):
            z += sum(float(weights[zlib.crc32(m.encode()) % len(weights)]) for m in {word + "$"} | {word[:n] for n in (4, 5, 6) if len(word) >= n})
        p = 1 / (1 + math.exp(-max(-30, min(30, z))))
        places.append((p, at, at + len(sentence)))
        chance *= 1 - min(p, 1 - 1e-12)
        at += len(sentence) + 1
    row = toxicity.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), tiny_model).first()
    worst = max(places)
    assert row.score == pytest.approx(1 - chance) and row.worst_score == pytest.approx(worst[0]) and (row.worst_start, row.worst_end) == worst[1:]


@pytest.mark.parametrize("which", ["odd", "none"])
def test_every_row_gets_a_language(which, request):
    docs = request.getfixturevalue(which)
    rows = language.predict(docs, language.train(docs, PIECES)).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in docs.collect())
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert 0 <= r.score <= 1 and r.lang_pred in ("en", "de", "und")
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, texts[r.doc_id] or "")))


def test_language_held_out(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = [r for r in queries.op7_language(spark, folder).collect() if r.held_out]
    assert all(held_out(r.doc_id) for r in rows) and np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) > 0.97


def test_a_text_that_does_not_fit_is_passed_over(spark):
    rows = spark.createDataFrame([(i, "x" * (100_000 if i % 7 == 0 else 10), i % 2) for i in range(50)], "_id long, _text string, _label int")
    found = bounded_sample(rows, 50_000)
    assert len(found) == 42 and all(len(text) == 10 for text, _ in found)


def test_one_long_text_does_not_empty_the_training(spark, documents):
    long = spark.range(10**6, 2 * 10**6).filter("crc32(cast(id AS string)) % 5 <> 0").orderBy(F.xxhash64("id")).first().id  # comes first
    docs = documents.unionByName(documents.limit(1).selectExpr(f"cast({long} AS long) AS doc_id", "repeat('lorem ipsum ', 100000) AS text", "lang", "source", "cast(1 AS long) AS n_chars"), allowMissingColumns=True)
    model = language.train(docs, PIECES, most_chars=300_000)
    assert len(model.languages) == 4


@pytest.mark.parametrize("part", [" ", ".", " .", "\n", "a ", "\t\x0b", "a.", "\x85", "!?"])
def test_sentences_in_linear_time(part):
    text = part * (3_000_000 // len(part))
    began = time.perf_counter()
    found = toxicity.sentences(text)
    assert time.perf_counter() - began < 3
    short = part * 40
    assert toxicity.sentences(short) == [m.span() for m in re.finditer(r"[^.!?\n]*[^.!?\s][^.!?\n]*", short)]
    assert len(found) == (0 if not re.search(r"[^.!?\s]", text) else text.count(".") or 1)
