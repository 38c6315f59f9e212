"""Language identification by unigram piece models, marginalised over segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A word's likelihood
is the sum over all its segmentations into pieces, by the forward algorithm; segmentations never
cross a word's bounds, so a text's log-likelihood is the sum over its words. Probabilities are
fitted by expectation-maximisation with the forward-backward algorithm on a bounded sample.

Words are runs of word characters with at least one letter, lower-cased, with the vocabulary's word
mark in front. A character that no piece covers is its own piece at a fixed small probability. Words
of any length are learned from and scored; those over `_LONG` letters one at a time, rescaled.

Cases: texts that are null or have no letter are `und` with score 0; rows without a language are
not learned from; ties go to the language that sorts first; without anything to learn from, every
text is `und`; repeated rows are predicted as often as they occur, and one row of an id (the smallest
text) is learned from; very long texts are scored whole, some hundred thousand words at a time; an
empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.llm._common import bounded_sample, bucket_of, chunks, column_rows, narrow, record_batch, resident

UNKNOWN_LANGUAGE = "und"
#: Bounds of the sample: rows of a language, rows in all, characters of their whole texts together,
#: and languages, the largest. The model has a row of LANGUAGES numbers at most for each piece.
ROWS_PER_LANGUAGE, SAMPLE_ROWS, SAMPLE_CHARS, LANGUAGES = 600, 20_000, 24_000_000, 1000
ROUNDS, SMOOTHING, FOREIGN = 2, 0.05, 1e-7
MARK = "▁"
_WORD = re.compile(r"[^\W\d_]+")
_LONG, _AT_ONCE = 32, 200_000
#: Numbers in the remembered likelihoods of a worker and in a lattice of words, at any number of languages.
_REMEMBERED, _LATTICE = 1_600_000, 1_400_000


@lru_cache(maxsize=2)
def vocabulary(model_file: str) -> dict[str, int]:
    """Piece to number; -1 for a text that only begins pieces."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [p for i in range(processor.get_piece_size()) if not (processor.is_control(i) or processor.is_byte(i) or processor.is_unknown(i)) and (p := processor.id_to_piece(i))]
    known = {p: n for n, p in enumerate(pieces)}
    for p in pieces:
        for n in range(1, len(p)):
            known.setdefault(p[:n], -1)
    return known


def words_of(text: str | None) -> list[str]:
    low = (text or "").lower()
    found = _WORD.findall(low)
    return found if low.isascii() else [w for w in found if w.isalpha() or any(map(str.isalpha, w))]


def words_at_once(languages: int) -> int:
    """Words that a lattice may hold."""
    return max(16, _LATTICE // ((_LONG + 2) * max(1, languages)))


def edges_from(marked: str, start: int, known: dict[str, int], foreign: int) -> list[tuple[int, int]]:
    """(stop, piece) of the pieces that begin at start; a lone foreign one if none covers its letter."""
    found, covered = [], False
    for stop in range(start + 1, len(marked) + 1):
        piece = known.get(marked[start:stop])
        if piece is None:
            break
        if piece >= 0:
            covered = covered or stop == start + 1
            found.append((stop, piece))
    return found if covered else [*found, (start + 1, foreign)]


class Lattice:
    """All pieces of many words, by start and length."""

    def __init__(self, words: list[str], known: dict[str, int], foreign: int):
        self.n, self.longest = len(words), max(map(len, words)) + 1
        self.ends = np.array([len(w) + 1 for w in words])
        rows, ids = defaultdict(list), defaultdict(list)
        for k, word in enumerate(words):
            marked = MARK + word
            for start in range(len(marked)):
                for stop, piece in edges_from(marked, start, known, foreign):
                    rows[start, stop].append(k)
                    ids[start, stop].append(piece)
        self.edges = [(a, b, np.array(rows[a, b]), np.array(ids[a, b])) for a, b in sorted(rows)]

    def forward(self, table: np.ndarray) -> np.ndarray:
        """alpha[word, position, language]."""
        alpha = np.zeros((self.n, self.longest + 1, table.shape[1]))
        alpha[:, 0] = 1
        for a, b, k, i in self.edges:
            alpha[k, b] += alpha[k, a] * table[i]
        return alpha

    def likelihood(self, table: np.ndarray) -> np.ndarray:
        return self.forward(table)[np.arange(self.n), self.ends]

    def expected(self, table: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece by language, words weighted by their counts."""
        alpha = self.forward(table)
        whole = np.arange(self.n)
        beta = np.zeros_like(alpha)
        beta[whole, self.ends] = weight / np.maximum(alpha[whole, self.ends], 1e-300)
        out = np.zeros_like(table)
        for a, b, k, i in reversed(self.edges):
            through = table[i] * beta[k, b]
            np.add.at(out, i, alpha[k, a] * through)
            beta[k, a] += through
        return out


def long_forward(marked: str, known: dict[str, int], table: np.ndarray) -> Iterator[np.ndarray]:
    """Log of the forward sums at each position, one after the other, rescaled at each."""
    ahead, scale = {0: np.ones(table.shape[1])}, np.zeros(table.shape[1])
    for start in range(len(marked) + 1):
        top = np.maximum(ahead.pop(start), 1e-300)
        scale = scale + np.log(top)
        yield scale
        ahead = {b: v / top for b, v in ahead.items()}
        if start < len(marked):
            for stop, piece in edges_from(marked, start, known, len(table) - 1):
                ahead[stop] = ahead.get(stop, 0) + table[piece]


def long_uses(word: str, known: dict[str, int], table: np.ndarray, uses: np.ndarray, weight: np.ndarray) -> None:
    """Adds the expected uses of pieces by one word of any length. Only the languages that have the
    word are looked at. The chance that a piece is used is that of its end being a bound of pieces,
    times the share of the forward sum there that comes through the piece."""
    has = np.flatnonzero(weight)
    marked, own = MARK + word, table[:, has]
    sums = list(long_forward(marked, known, own))
    bound = [np.zeros(len(has)) for _ in sums]
    bound[-1] = weight[has].astype(float)
    for start in range(len(marked) - 1, -1, -1):
        for stop, piece in edges_from(marked, start, known, len(table) - 1):
            used = own[piece] * np.exp(sums[start] - sums[stop]) * bound[stop]
            uses[piece, has] += used
            bound[start] = bound[start] + used


class Model:
    """Languages and the table of piece probabilities, the last row for foreign characters."""

    def __init__(self, languages: list[str], table: np.ndarray, model_file: str):
        self.languages, self.table, self.model_file, self.token = languages, table, model_file, uuid.uuid4().hex


def fit(texts: list[str], languages: list[str], model_file: str, rounds: int = ROUNDS) -> Model:
    known = vocabulary(model_file)
    pieces = 1 + max(known.values())
    names = sorted(set(languages))
    counts: list[Counter] = [Counter() for _ in names]
    for text, language in zip(texts, languages, strict=True):
        counts[names.index(language)].update(words_of(text))
    table = np.full((pieces + 1, len(names)), 1 / pieces)
    table[-1] = FOREIGN
    words = sorted(set().union(*counts)) if counts else []
    short, long = [w for w in words if len(w) <= _LONG], [w for w in words if len(w) > _LONG]
    step = words_at_once(len(names))
    for _ in range(rounds if words else 0):
        uses = np.full_like(table, SMOOTHING)
        for low in range(0, len(short), step):
            part = short[low : low + step]
            weight = np.array([[c[w] for c in counts] for w in part], float)
            uses += Lattice(part, known, pieces).expected(table, weight)
        for word in long:
            long_uses(word, known, table, uses, np.array([c[word] for c in counts], float))
        uses = uses[:-1]
        table = np.vstack([uses / uses.sum(axis=0), np.full((1, len(names)), FOREIGN)])
    return Model(names, table, model_file)


class Scorer:
    """Log-likelihoods of texts; those of words are remembered in a bounded array."""

    def __init__(self, model: Model):
        self.model, self.known = model, vocabulary(model.model_file)
        self.index: dict[str, int] = {}
        self.values = np.zeros((1 << 12, len(model.languages)))

    def long_word(self, word: str) -> np.ndarray:
        """The forward algorithm over one word, rescaled at each position."""
        for last in long_forward(MARK + word, self.known, self.model.table):
            pass
        return last

    def learn(self, words: set[str]) -> None:
        todo, step = sorted(words), words_at_once(self.values.shape[1])
        low, high = len(self.index), len(self.index) + len(todo)
        if high > len(self.values):
            grown = np.zeros((max(high, 2 * len(self.values)), self.values.shape[1]))
            grown[:low] = self.values[:low]
            self.values = grown
        for at in range(0, len(todo), step):
            part = todo[at : at + step]
            self.values[low + at : low + at + len(part)] = np.log(np.maximum(Lattice(part, self.known, len(self.model.table) - 1).likelihood(self.model.table), 1e-300))
        self.index.update(zip(todo, range(low, high), strict=True))

    def learn_batch(self, split: list[list[str]]) -> None:
        """Looks up the short words of texts that have _AT_ONCE words at most."""
        short = {w for w in set().union(*split) if len(w) <= _LONG}
        new = short - self.index.keys()
        if len(self.index) + len(new) > max(len(short), _REMEMBERED // max(1, self.values.shape[1])):
            self.index.clear()
            new = short
        self.learn(new)

    def total(self, words: list[str]) -> np.ndarray:
        """Log-likelihood of words whose short ones are looked up."""
        short = [w for w in words if len(w) <= _LONG]
        out = self.values[np.fromiter(map(self.index.__getitem__, short), np.int64, len(short))].sum(axis=0)
        return sum((self.long_word(w) for w in words if len(w) > _LONG), out) if len(short) < len(words) else out

    def decide(self, total: np.ndarray) -> tuple[str, float]:
        share = np.exp(total - total.max())
        best = int(np.argmax(total))
        return self.model.languages[best], float(share[best] / share.sum())

    def scores(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNKNOWN_LANGUAGE, 0.0)] * len(texts)
        split = [(i, words) for i, text in enumerate(texts) if self.model.languages and (words := words_of(text))]
        while split:
            here, size = [], 0
            while split and (not here or size + len(split[-1][1]) <= _AT_ONCE):
                here.append(split.pop())
                size += len(here[-1][1])
            if size <= _AT_ONCE:
                self.learn_batch([words for _, words in here])
                for i, words in here:
                    out[i] = self.decide(self.total(words))
            else:  # one very long text
                i, words = here[0]
                whole = np.zeros(self.values.shape[1])
                for low in range(0, len(words), _AT_ONCE):
                    part = words[low : low + _AT_ONCE]
                    self.learn_batch([part])
                    whole = whole + self.total(part)
                out[i] = self.decide(whole)
        return out


def scorer_of(model: Model) -> Scorer:
    """One scorer for all tasks of a Python worker."""
    return resident(("language", model.token), lambda: Scorer(model))


def train(docs: DataFrame, model_file: str, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", rows: int = ROWS_PER_LANGUAGE, most: int = SAMPLE_ROWS, most_chars: int = SAMPLE_CHARS) -> Model:
    """Fits on at most `rows` ids of each language that are not held out, `most` in all, the first by
    a hash of the id, whose texts have at most `most_chars` characters together; a text that does not
    fit into what is left is passed over. The ids are broadcast, and one text of each comes to the driver."""
    key = F.col(id_col).cast("long")
    able = docs.filter(bucket_of(key) != 0).select(key.alias("_id"), F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).alias("_text"))
    able = able.filter(F.col("_lang").isNotNull() & F.col("_id").isNotNull() & (F.length("_text") > 0))
    # A language keeps about twice the rows asked for before they are ranked, whatever its share.
    sizes = able.groupBy("_lang").agg(F.count(F.lit(1)).alias("_size")).orderBy(F.desc("_size"), "_lang").limit(LANGUAGES)
    share = F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) * F.col("_size") < F.lit(2 * rows) * (1 << 20)
    thin = able.select("_id", "_lang").join(F.broadcast(sizes), "_lang").filter(share)
    nth = F.row_number().over(W.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id"))
    ids = thin.select("_id", "_lang", nth.alias("_nth")).filter(F.col("_nth") <= rows).orderBy("_nth", "_lang").limit(most).select("_id").distinct()
    found = bounded_sample(able.join(F.broadcast(ids), "_id", "left_semi").withColumnRenamed("_lang", "_label"), most_chars)
    return fit([text for text, _ in found], [language for _, language in found], model_file)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score): the likeliest language and its share of the likelihoods."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(held.value)
        for batch in batches:
            for rows in chunks(column_rows(batch, ["doc_id", "text"]), 256):
                found = scorer.scores([text for _, text in rows])
                yield record_batch([(doc_id, *x) for (doc_id, _), x in zip(rows, found, strict=True)], schema)

    return narrow(docs, doc_id=F.col(id_col).cast("long"), text=F.col(text_col)).mapInArrow(run, "doc_id long, lang_pred string, score double")
