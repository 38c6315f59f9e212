"""Byte-level BPE: encoding with a segment tree over adjacent pairs, and decoding.

The leaves of the tree hold the merge rank of each symbol with its right neighbour; an inner node
holds the smaller of its children. The root is the lowest rank left; going down to the left child
whenever it holds that rank finds the leftmost such pair. A merge changes at most three leaves,
each in logarithmic time, so a word of n bytes takes O(n log n), however long it is.

Texts are cut at added tokens, then into words by the vocabulary's pattern; ids of short words are
remembered in a bounded table per task.

Cases: null and empty texts have no ids and decode to an empty text; null ids of documents are
carried through; repeated rows are encoded as often as they occur; an empty table gives an empty
result; other columns are never looked at.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm._common import Remembered, column_rows, narrow, resident

_ID = 24  # bits of an id
_ID_MASK = (1 << _ID) - 1
_NONE = 1 << 40
_NO_PAIR = _NONE << _ID
_BATCH_IDS, _BATCH_ROWS = 1 << 19, 1024
#: White space as Unicode has it; Python's own class also holds the separators 1C to 1F.
_SPACE = r"\t-\r\x20\x85\xa0  -     　"
#: A word with at most one space before it, white space up to the last before a word, other white space.
_CHUNK = re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: The published pattern of this vocabulary, a fixed value.
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files, and back."""
    shown = {b for first, last in (("!", "~"), ("\xa1", "\xac"), ("\xae", "\xff")) for b in range(ord(first), ord(last) + 1)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """What a vocabulary file says: ids of bytes, pairs that merge, bytes of ids, added tokens."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_alphabet()
        self.byte_ids = [0] * 256
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocab[letter]
        self.pairs: dict[int, int] = {}  # left << _ID | right: rank << _ID | id of both
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs.setdefault(vocab[left] << _ID | vocab[right], rank << _ID | vocab[left + right])
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.added = added
        self.token_bytes = {i: bytes(letters[c] for c in token) for token, i in vocab.items() if token not in added} | {i: t.encode() for t, i in added.items()}


class SegmentTree:
    """Minimum over leaves. A leaf holds rank * width + position, so the root names both the least
    rank and the leftmost pair that has it."""

    def __init__(self, ranks: list[int]):
        size = self.width = 1 << max(0, (len(ranks) - 1).bit_length())
        low = self.low = [0] * size + [r * size + i for i, r in enumerate(ranks)] + [_NONE * size] * (size - len(ranks))
        while size > 1:
            low[size // 2 : size] = map(min, low[size : 2 * size : 2], low[size + 1 : 2 * size : 2])
            size //= 2

    def leftmost(self) -> int:
        """The first leaf that holds the least rank; -1 if none is left."""
        least = self.low[1]
        return -1 if least >= _NONE * self.width else least & (self.width - 1)

    def put(self, leaf: int, rank: int) -> None:
        low, i = self.low, leaf + self.width
        low[i] = rank * self.width + leaf
        while i > 1:
            a, b = low[i], low[i ^ 1]
            i >>= 1
            least = a if a < b else b
            if low[i] == least:
                return
            low[i] = least


def merge_word(ids: list[int], pairs: dict[int, int]) -> list[int]:
    """The ids left when no adjacent pair merges any more. pairs: see Merges."""
    n = len(ids)
    if n < 2:
        return ids
    ids, rank_of = list(ids), pairs.get
    tree = SegmentTree([rank_of(a << _ID | b, _NO_PAIR) >> _ID for a, b in zip(ids, ids[1:])])
    following, before = list(range(1, n + 1)), list(range(-1, n - 1))
    low, width = tree.low, tree.width
    none = _NONE * width
    while (least := low[1]) < none:
        i = least & (width - 1)
        j = following[i]
        ids[i] = new = pairs[ids[i] << _ID | ids[j]] & _ID_MASK
        ids[j] = -1
        k = following[i] = following[j]
        if k < n:
            before[k] = i
            changed = [(j, none), (i, (rank_of(new << _ID | ids[k], _NO_PAIR) >> _ID) * width + i)]
        else:
            changed = [(i, none)]
        if (h := before[i]) >= 0:
            changed.append((h, (rank_of(ids[h] << _ID | new, _NO_PAIR) >> _ID) * width + h))
        for leaf, value in changed:  # SegmentTree.put, in place
            at = leaf + width
            low[at] = value
            while at > 1:
                other = low[at ^ 1]
                if other < value:
                    value = other
                at >>= 1
                if low[at] == value:
                    break
                low[at] = value
    return [x for x in ids if x >= 0]


class Codec(Remembered):
    """Remembers the ids of chunks, as little-endian bytes: a chunk is what stands between white
    space with the space before it, and may be several words of the pattern."""

    entries = 750_000

    def __init__(self, file: str):
        super().__init__()
        self.merges = Merges(file)
        added = sorted(self.merges.added, key=len, reverse=True)
        self.added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        self.marks: dict[str, bytes] = {}  # ids of closing marks, of which there are few

    def word(self, word: str) -> bytes:
        start = self.merges.byte_ids
        return array("i", merge_word([start[b] for b in word.encode("utf-8")], self.merges.pairs)).tobytes()

    def make(self, chunk: str) -> bytes:
        core = chunk.rstrip(".,;:!?")
        if core.removeprefix(" ").isalpha():  # the pattern parts these in two at sight
            marks = chunk[len(core) :]
            if not marks:
                return self.word(core)
            if (ids := self.marks.get(marks)) is None:
                ids = self.word(marks)
                if len(marks) <= 3:
                    self.marks[marks] = ids
            return (self.get(core) or self.word(core)) + ids
        return b"".join(map(self.word, _WORD.findall(chunk)))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.added is None or not self.added.search(text):
            return b"".join(map(self.__getitem__, _CHUNK.findall(text)))
        parts = []
        for i, part in enumerate(self.added.split(text)):
            parts.append(np.array([self.merges.added[part]], "<i4").tobytes() if i % 2 else b"".join(map(self.__getitem__, _CHUNK.findall(part))))
        return b"".join(parts)

    def decode(self, ids: list[int | None]) -> str:
        """The text of ids; null and unknown ids stand for nothing, as in the library."""
        known = self.merges.token_bytes
        try:
            raw = b"".join(map(known.__getitem__, ids))
        except KeyError:
            raw = b"".join(known.get(i, b"") for i in ids)
        return raw.decode("utf-8", "replace")


def codec_of(file: str) -> Codec:
    """One codec for all tasks of a Python worker."""
    return resident(("bpe", file), lambda: Codec(file))


def encode(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(doc_id, ids), ids an array<int>; with decoded also the text decoded from those ids."""
    fields = [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))] + [("decoded", pa.string())] * decoded
    schema = pa.schema(fields)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        flat = np.frombuffer(b"".join(r[1] for r in rows), "<i4")
        ends = np.cumsum([0] + [len(r[1]) // 4 for r in rows]).astype(np.int32)
        arrays = [pa.array([r[0] for r in rows], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
        if decoded:
            arrays.append(pa.array([r[2] for r in rows], pa.string()))
        return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, rows, held = codec_of(file), [], 0
        for batch in batches:
            for doc_id, text in column_rows(batch, ["doc_id", "text"]):
                ids = codec.encode(text)
                rows.append((doc_id, ids, codec.decode(np.frombuffer(ids, "<i4").tolist())) if decoded else (doc_id, ids))
                held += len(ids) // 4
                if held >= _BATCH_IDS or len(rows) >= _BATCH_ROWS:
                    yield batch_of(rows)
                    rows, held = [], 0
        if rows:
            yield batch_of(rows)

    texts = narrow(docs, doc_id=F.col(id_col).cast("long"), text=F.col(text_col))
    return texts.mapInArrow(run, "doc_id long, ids array<int>" + ", decoded string" * decoded)


def decode(encoded: DataFrame, file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded): the text of each array of ids; bytes that are no UTF-8 are replaced."""
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(file)
        for batch in batches:
            rows = [(doc_id, codec.decode(ids or [])) for doc_id, ids in column_rows(batch, ["doc_id", "ids"])]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], schema=schema)

    return narrow(encoded, doc_id=F.col(id_col).cast("long"), ids=F.col(ids_col)).mapInArrow(run, "doc_id long, decoded string")
