"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence's logit is a bias plus the weights of its words; a word's weight sums hashed features of
the whole word and of its beginnings, so that unseen compounds of a known beginning are scored too.
A document's score is the noisy-or of its sentences, 1 - prod(1 - p). The weights are fitted to
document labels through the noisy-or on a bounded sample of labelled rows; the sentence scores then
locate what is offensive.

Cases: null and empty texts have no sentence and score 0; null labels are no labels; if the sample
lacks one of the labels, all weights are zero and every score is 0 (or 1, if all labels are 1 and
the text has a sentence); repeated rows are scored as often as they occur, and one row of an id (the
smallest text) is learned from; very long texts are scored whole, sentence by sentence; empty tables
give an empty result; other columns are never looked at.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from math import exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm._common import Remembered, bounded_sample, bucket_of, chunks, column_rows, narrow, record_batch, resident

#: Bounds of the sample: labelled rows, and characters of their whole texts together.
SAMPLE_ROWS, SAMPLE_CHARS = 5000, 24_000_000
DIMENSIONS, BEGINNINGS, EPOCHS, RATE, DECAY = 1 << 18, (4, 5, 6), 120, 0.1, 0.3
#: What a feature must show to weigh: rows that have it, and standard deviations above chance.
MIN_ROWS, MIN_SIGMA = 3, 3.5
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")
_EPS = 1e-12


def features(word: str) -> list[int]:
    """Hashed features of a lower-case word."""
    marks = [word + "$", *(word[:n] for n in BEGINNINGS if len(word) >= n)]
    return [zlib.crc32(m.encode("utf-8")) % DIMENSIONS for m in marks]


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Spans of sentences, in code points: what lies between marks and is not blank."""
    return [m.span() for m in _SENTENCE.finditer(text or "") if not m[0].isspace()]


def fit(texts: list[str], labels: list[int]) -> tuple[np.ndarray, float]:
    """Weights and bias, by Adam on the likelihood of document labels under the noisy-or."""
    weights = np.zeros(DIMENSIONS, np.float32)
    y = np.array(labels, bool)
    if not len(y) or y.all() or not y.any():
        return weights, 30.0 if len(y) and y.all() else -30.0
    known: dict[str, int] = {}
    word_ids, sentence_len, doc_len = array("i"), array("i"), array("i")
    for text in texts:
        n = 0
        for a, b in sentences(text):
            found = [known.setdefault(w, len(known)) for w in _WORD.findall(text[a:b].lower())]
            word_ids.extend(found)
            sentence_len.append(len(found))
            n += 1
        doc_len.append(n)
    words = np.frombuffer(word_ids, np.int32) if word_ids else np.zeros(0, np.int32)
    of_sentence = np.repeat(np.arange(len(sentence_len), dtype=np.int32), sentence_len)
    of_doc = np.repeat(np.arange(len(y), dtype=np.int32), doc_len)
    listed, listed_len = array("i"), array("i")
    for w in known:
        found = features(w)
        listed.extend(found)
        listed_len.append(len(found))
    feature = np.array(listed, np.int32)
    of_word = np.repeat(np.arange(len(known), dtype=np.int32), listed_len)
    n_words, n_sentences, n_docs = len(known), len(sentence_len), len(y)
    theta, bias = np.zeros(DIMENSIONS), -5.0
    # Only features that documents labelled 1 have clearly more often than chance may weigh anything.
    doc_of_word = np.unique(of_doc[of_sentence].astype(np.int64) * n_words + words)
    seen = np.bincount(doc_of_word % n_words, minlength=n_words), np.bincount(doc_of_word % n_words, weights=y[doc_of_word // n_words].astype(float), minlength=n_words)
    rows, bad = (np.bincount(feature, of[of_word], DIMENSIONS) for of in seen)
    base = y.mean()
    free = (rows >= MIN_ROWS) & (bad - rows * base >= MIN_SIGMA * np.sqrt(rows * base * (1 - base)))
    moment, square = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
    for step in range(1, EPOCHS + 1):
        of = np.bincount(of_word, theta[feature], n_words)
        z = bias + np.bincount(of_sentence, of[words], n_sentences)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.exp(np.bincount(of_doc, np.log1p(-np.minimum(p, 1 - _EPS)), n_docs))
        some = np.maximum(1 - none, _EPS)
        slope = np.where(y, -none / some, 1.0)[of_doc] * p
        by_word = np.bincount(words, slope[of_sentence], n_words)
        grad = np.append(np.bincount(feature, by_word[of_word], DIMENSIONS) + DECAY * theta, slope.sum())
        moment += 0.1 * (grad - moment)
        square += 0.01 * (grad * grad - square)
        move = RATE * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        theta = np.where(free, np.maximum(theta - move[:-1], 0), 0)
        bias -= move[-1]
    return theta.astype(np.float32), float(bias)


def noisy_or(spans: list[tuple[int, int, float]]) -> float:
    """The chance that at least one of the scored spans is offensive."""
    return 1 - exp(sum(log1p(-min(p, 1 - _EPS)) for _, _, p in spans)) if spans else 0.0


class WordWeights(Remembered):
    entries = 20_000

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def make(self, word: str) -> float:
        return float(sum(self.weights[f] for f in features(word)))


class Scorer:
    """Scores of a text and of its sentences."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.words, self.bias = WordWeights(weights), bias

    def sentence(self, words: list[str]) -> float:
        z = self.bias + sum(map(self.words.__getitem__, words))
        return 1 / (1 + exp(-min(30.0, max(-30.0, z))))

    def located(self, text: str | None) -> list[tuple[int, int, float]]:
        return [(a, b, self.sentence(_WORD.findall(text[a:b].lower()))) for a, b in sentences(text)]

    def score(self, text: str | None) -> float:
        return noisy_or(self.located(text))


def scorer_of(model: tuple[np.ndarray, float]) -> Scorer:
    """One scorer for all tasks of a Python worker; the key is a hash of the weights."""
    key = zlib.crc32(model[0].tobytes(), zlib.crc32(repr(model[1]).encode()))
    return resident(("toxicity", key), lambda: Scorer(*model))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS, most_chars: int = SAMPLE_CHARS) -> tuple[np.ndarray, float]:
    """Fits on at most `rows` labelled ids that are not held out, the first by a hash of the id, whose
    texts have at most `most_chars` characters together; a text that does not fit into what is left is
    passed over. The ids are broadcast, and one text of each comes to the driver."""
    key = F.col(id_col).cast("long")
    marked = labels.select(key.alias("_id"), F.col(label_col).cast("int").alias("_label")).filter("_id IS NOT NULL AND _label IN (0, 1)").filter(bucket_of(F.col("_id")) != 0)
    sample = marked.groupBy("_id").agg(F.max("_label").alias("_label")).orderBy(F.xxhash64("_id"), "_id").limit(rows)
    texts = docs.select(key.alias("_id"), F.col(text_col).alias("_text")).filter(F.length("_text") > 0)
    found = bounded_sample(texts.join(F.broadcast(sample), "_id"), most_chars)
    return fit([text for text, _ in found], [label for _, label in found])


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, worst_start, worst_end, worst_score), one row per document: the last three tell
    the sentence that scores most (the first of equals), null without a sentence."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("worst_start", pa.int64()), ("worst_end", pa.int64()), ("worst_score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(held.value)
        for batch in batches:
            for rows in chunks(column_rows(batch, ["doc_id", "text"]), 4096):
                found = [(doc_id, scorer.located(text)) for doc_id, text in rows]
                yield record_batch([(doc_id, noisy_or(spans), *max(spans, key=lambda s: s[2], default=(None,) * 3)) for doc_id, spans in found], schema)

    return narrow(docs, doc_id=F.col(id_col).cast("long"), text=F.col(text_col)).mapInArrow(run, "doc_id long, score double, worst_start long, worst_end long, worst_score double")


def locate(docs: DataFrame, model: tuple[np.ndarray, float], least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, end, score): the sentences that score at least `least`, in code points."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(held.value)
        for batch in batches:
            found = ((doc_id, a, b, p) for doc_id, text in column_rows(batch, ["doc_id", "text"]) for a, b, p in scorer.located(text) if p >= least)
            for rows in chunks(found, 4096):
                yield record_batch(rows, schema)

    return narrow(docs, doc_id=F.col(id_col).cast("long"), text=F.col(text_col)).mapInArrow(run, "doc_id long, start long, end long, score double")


def keep_clean(docs: DataFrame, model: tuple[np.ndarray, float], most: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs that score under `most`, with all their columns."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(held.value)
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(text) < most for (text,) in column_rows(batch, [text_col])], pa.bool_()))

    return narrow(docs).mapInArrow(run, docs.schema)
