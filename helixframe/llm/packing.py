"""Packing token ids into sequences of a fixed length: bounded-space online best fit.

Each partition keeps a fixed number of open windows. A document's full lengths become sequences of
their own; its tail goes to the open window with the least room that holds it. When none holds it
and no further window may be opened, the fullest is closed: first topped up with the head of the
tail if neither part gets shorter than `min_cut`, then emitted. What is open at the end of a
partition is left over; leftovers of neighbouring partitions are merged by pouring the emptiest
windows into the room of the fullest, so that one window per `fan_in` partitions stays partly full.

Memory: `windows` open windows of `length` ids and one document per task; a merging task holds
`fan_in` times `windows` windows.

Cases: a null or empty text is the end id alone; a null id is carried through; repeated rows are
packed as often as they occur; very long texts are cut; an empty table gives an empty result; other
columns are never looked at.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm._common import Remembered, chunks, column_rows, narrow, record_batch, resident
from helixframe.llm.bpe import byte_alphabet
from helixframe.storage import scratch

LENGTH, WINDOWS, MIN_CUT, FAN_IN = 2048, 32, 8, 16
#: Chunks of text whose ids a Python worker remembers, in each of two generations: about 0.4 KB each.
REMEMBERED = 800_000
#: What str.split takes for white space and the tokenizer does not.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("part", pa.int64()), ("ids", pa.binary())])
_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part long, ids binary"


class CoreIds(Remembered):
    """Ids of a chunk without closing marks. A core of letters alone is one word, so its bytes go
    to the tokenizer's merges at once; all others go through the whole tokenizer."""

    def __init__(self, tokenizer_file: str, entries: int):
        from tokenizers import Tokenizer

        super().__init__()
        self.entries = entries
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.merge = self.tokenizer.model.tokenize
        #: Tokens that the tokenizer takes out of a text before it is lower-cased.
        self.added = [token.content.lower() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.letter = {byte: letter for letter, byte in byte_alphabet().items()}

    def encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def make(self, core: str) -> bytes:
        if core.isalpha():
            low = core.lower()
            if not core.isascii():
                if len(low) != len(core) or not low.isalpha() or "Σ" in core or not is_normalized("NFC", core):
                    return self.encode(core)
                low = "".join(map(self.letter.__getitem__, low.encode("utf-8")))
            return array("I", [token.id for token in self.merge(low)]).tobytes()
        return self.encode(core)


class ChunkIds(Remembered):
    """Ids of a text between white space, as little-endian bytes. The tokenizer drops white space
    and never joins across it, so a text's ids are those of its chunks in a row. It lower-cases,
    and parts letters and digits from marks: a chunk's ids are those of its core and its closing
    marks, and ASCII cores that differ in case share theirs. Added tokens are told by their case:
    a chunk that holds one in any case goes to the tokenizer as it is."""

    def __init__(self, tokenizer_file: str, entries: int):
        super().__init__()
        self.entries, self.cores = entries, CoreIds(tokenizer_file, entries // 4)

    def make(self, chunk: str) -> bytes:
        low = chunk.lower()
        if any(token in low for token in self.cores.added):
            return self.cores.encode(chunk)
        core = chunk.rstrip(".,;:!?")
        if len(core) < len(chunk) and core and core[-1].isalnum() and len(core[-1].lower()) == 1:
            return self.make(core) + self.cores[chunk[len(core) :]]
        return self.cores[low if chunk.isascii() else chunk]

    def of(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _NOT_SPACE.search(text):
            return self.cores.encode(text)
        return b"".join(map(self.__getitem__, text.split()))


def chunk_ids(tokenizer_file: str, entries: int = REMEMBERED) -> ChunkIds:
    """One table for all tasks of a Python worker."""
    return resident(("packing", tokenizer_file, entries), lambda: ChunkIds(tokenizer_file, entries))


class Window:
    __slots__ = ("fill", "pieces")

    def __init__(self):
        self.fill, self.pieces = 0, []

    def add(self, piece: tuple) -> None:
        self.pieces.append(piece)
        self.fill += len(piece[2]) // 4


def cut(piece: tuple, at: int) -> tuple[tuple, tuple]:
    """Both parts of a piece (doc_id, start, ids, doc_tokens)."""
    doc_id, start, ids, tokens = piece
    return (doc_id, start, ids[: 4 * at], tokens), (doc_id, start + at, ids[4 * at :], tokens)


class Packer:
    """Open windows of one partition. `put` yields windows that are closed."""

    def __init__(self, length: int, windows: int, min_cut: int):
        self.length, self.windows, self.min_cut, self.open = length, windows, min_cut, []

    def put(self, doc_id: int | None, ids: bytes) -> Iterator[Window]:
        tokens = len(ids) // 4
        whole = tokens - tokens % self.length
        for start in range(0, whole, self.length):
            window = Window()
            window.add((doc_id, start, ids[4 * start : 4 * (start + self.length)], tokens))
            yield window
        rest = (doc_id, whole, ids[4 * whole :], tokens)
        while rest[2]:
            size = len(rest[2]) // 4
            fits = [w for w in self.open if self.length - w.fill >= size]
            if fits:
                best = max(fits, key=lambda w: w.fill)
                best.add(rest)
                if best.fill == self.length:
                    self.open.remove(best)
                    yield best
                return
            if len(self.open) < self.windows:
                self.open.append(Window())
                continue
            fullest = max(self.open, key=lambda w: w.fill)
            room = self.length - fullest.fill
            if room >= self.min_cut and size - room >= self.min_cut:
                head, rest = cut(rest, room)
                fullest.add(head)
            self.open.remove(fullest)
            yield fullest


def merge(windows: list[Window], length: int) -> list[Window]:
    """The same pieces in full windows and at most one that is not: the emptiest are poured into
    the fullest, cut where the room ends."""
    todo = sorted(windows, key=lambda w: w.fill)
    out, low, high = [], 0, len(todo) - 1
    while low < high:
        target, source = todo[high], todo[low]
        while source.pieces and target.fill < length:
            piece = source.pieces.pop()
            source.fill -= len(piece[2]) // 4
            room = length - target.fill
            if len(piece[2]) // 4 > room:
                piece, back = cut(piece, room)
                source.add(back)
            target.add(piece)
        if target.fill == length:
            out.append(target)
            high -= 1
        if not source.pieces:
            low += 1
    return out + [w for w in todo[low : high + 1] if w.pieces]


def _rows(window: Window, sequence: int | None, part: int, with_ids: bool) -> Iterator[tuple]:
    at = 0
    for doc_id, start, ids, tokens in window.pieces:
        size = len(ids) // 4
        yield doc_id, start, size, zlib.crc32(ids), tokens, sequence, at, part, bytes(ids) if with_ids or sequence is None else None
        at += size


def pack(docs: DataFrame, tokenizer_file: str, end_id: int = 1, length: int = LENGTH, windows: int = WINDOWS, min_cut: int = MIN_CUT, fan_in: int = FAN_IN, remembered: int = REMEMBERED, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    ids holds the piece's little-endian 32-bit ids, null unless with_ids. Every id of a document,
    end_id last, lies in exactly one piece; a sequence's pieces follow each other from offset 0."""
    end = np.array([end_id], "<u4").tobytes()

    def online(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        known, packer, made = chunk_ids(tokenizer_file, remembered), Packer(length, windows, min_cut), 0

        def rows() -> Iterator[tuple]:
            nonlocal made
            for batch in batches:
                for doc_id, text in column_rows(batch, ["doc_id", "text"]):
                    for window in packer.put(doc_id, known.of(text) + end):
                        yield from _rows(window, (part << 33) | made, part, with_ids)
                        made += 1
            for window in packer.open:
                yield from _rows(window, None, (part << 33) | made, with_ids)
                made += 1

        for held in chunks(rows(), 512 if with_ids else 4096):
            yield record_batch(held, _SCHEMA)

    def merged(group: pa.Table) -> pa.Table:
        held: dict[int, Window] = {}
        for row in sorted(group.to_pylist(), key=lambda r: r["part"]):
            held.setdefault(row["part"], Window()).add((row["doc_id"], row["start"], row["ids"], row["doc_tokens"]))
        base = (1 << 62) | ((min(held) >> 33) // fan_in << 33)
        out = [r for i, w in enumerate(merge(list(held.values()), length)) for r in _rows(w, base | i, 0, with_ids)]
        return pa.Table.from_batches([record_batch(out, _SCHEMA)])

    texts = narrow(docs, doc_id=F.col(id_col).cast("long"), text=F.col(text_col))
    first = scratch(texts.mapInArrow(online, _DDL), "packing")
    closed = first.filter("sequence_id IS NOT NULL")
    left = first.filter("sequence_id IS NULL").withColumn("near", F.expr(f"shiftright(part, 33) div {fan_in}"))
    poured = left.groupBy("near").applyInArrow(merged, _DDL)
    return closed.unionByName(poured).drop("part")
