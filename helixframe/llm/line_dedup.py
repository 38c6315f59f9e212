"""Line dedup by sharded minimal perfect hashing.

A line's key is the line without blanks at its ends and with A-Z lower-cased. Keys that are long enough
and found in enough documents lose all their lines, except in the document with the largest id that
has them.

Keys are told by a 128-bit hash in two halves. The different keys of each document are counted over the corpus
(by key and document first, so that a line in a third of all documents is spread over tasks). Keys of
one document can never be dropped, at any threshold; the hashes of all others go to shards. A shard is a
minimal perfect hash: a cascade of bit arrays, where each level gives a bit to the keys that meet no
other one and leaves the rest to the next level; a key's place is the number of set bits before its own.
The place indexes three flat arrays: a fingerprint (the second half), the number of documents, and the
largest id. A shard is one row of bytes, of `SHARD_KEYS` keys at most on average.

Documents probe the arrays: a line's hash names its shard and place, the fingerprint there tells whether
the line is known at all, and count and holder decide. If all shards together are at most
`BROADCAST_BYTES` (measured before), each task holds them and documents are not moved at all. Beyond
that, narrow requests (two hashes, a number) go to the tasks that hold a shard, a shard with many requests
being copied to several tasks; the answers come back as line numbers, and only documents that lose a
line are moved. A foreign line passes for a known one with a chance of 2^-64, as fingerprints are whole
hashes; that is why they are not shorter.

Cases: a null or empty text is one empty line; a document is an id: rows that share an id are one
document when counted, each with its own lines; rows with a null id are one document together, and hold
a key only if no id does; very long texts are split whole; repeated lines of a document count once and
stay or go together; an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.llm._common import chunks, column_rows, maybe_in, membership_filter, narrow, record_batch, resident, row_key, small_side
from helixframe.storage import release, scratch

LEAST_CHARS, LEAST_DOCS = 40, 5
#: Keys of a shard on average, bytes of all shards up to which they are broadcast, and requests that one
#: task answers from a shard.
SHARD_KEYS, BROADCAST_BYTES, REQUESTS = 500_000, 64 << 20, 2_000_000
_BLANKS = b" \t\n\x0b\x0c\r"
#: Bits of a level for each key that it gets.
_ROOM = 2
_NOBODY = -(1 << 63)  # stands for "no id" in the array of holders


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed(text: str | None, least_chars: int) -> tuple[list[int], np.ndarray]:
    """The numbers of the lines whose key is long enough, and two hashes of each key."""
    places, digests = [], []
    for at, line in enumerate((text or "").encode("utf-8").split(b"\n")):
        if len(line) >= least_chars and len(key := line.strip(_BLANKS)) >= least_chars:
            if len(key) >= 4 * least_chars or len(key.decode("utf-8")) >= least_chars:
                places.append(at)
                digests.append(xxhash.xxh3_128_digest(key.lower()))  # of bytes: A-Z only
    return places, np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)


def _mixed(h: np.ndarray, g: np.ndarray, level: int) -> np.ndarray:
    """A hash of both hashes for a level."""
    x = h ^ (g * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((level + 1) * 0xD1B54A32D192ED03 % (1 << 64))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Different pairs of hashes to 0 .. n - 1, without a gap; foreign pairs to anything or to none."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # the words of each level's bits
        self.before = []  # set bits before each word, over all levels
        total = 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.before.append(total + np.cumsum(ones) - ones)
            total += int(ones.sum())
        self.size = total

    @classmethod
    def build(cls, h: np.ndarray, g: np.ndarray) -> PerfectHash:
        levels = []
        while len(h):
            bits = 64 * -(-_ROOM * len(h) // 64)
            at = (_mixed(h, g, len(levels)) % np.uint64(bits)).astype(np.int64)
            alone = np.bincount(at, minlength=bits)[at] == 1
            flags = np.zeros(bits, np.uint8)
            flags[at[alone]] = 1
            levels.append(np.packbits(flags, bitorder="little").view("<u8"))
            h, g = h[~alone], g[~alone]
        return cls(levels)

    def places(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        """The place of each pair, -1 for what no level has."""
        out, todo = np.full(len(h), -1, np.int64), np.arange(len(h))
        for level, (words, before) in enumerate(zip(self.levels, self.before, strict=True)):
            if not len(todo):
                break
            at = _mixed(h[todo], g[todo], level) % np.uint64(64 * len(words))
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            held = words[word]
            found = (held >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(held & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[found]] = (before[word] + below)[found]
            todo = todo[~found]
        return out


class Shard(NamedTuple):
    """The arrays of a shard's keys, in the places that its hash gives them."""

    hash: PerfectHash
    fingerprints: np.ndarray
    counts: np.ndarray
    holders: np.ndarray

    def doomed(self, h: np.ndarray, g: np.ndarray, doc_ids: np.ndarray, least: int) -> np.ndarray:
        """Whether lines with these hashes go from these documents."""
        at = self.hash.places(h, g)
        known = np.flatnonzero(at >= 0)
        place, out = at[known], np.zeros(len(h), bool)
        out[known] = (self.fingerprints[place] == g[known]) & (self.counts[place] >= least) & (self.holders[place] != doc_ids[known])
        return out


def _packed(h: np.ndarray, g: np.ndarray, counts: np.ndarray, holders: np.ndarray) -> tuple[list[bytes], bytes, bytes, bytes]:
    made = PerfectHash.build(h, g)
    order = np.empty(len(h), np.int64)
    order[made.places(h, g)] = np.arange(len(h))
    return [w.tobytes() for w in made.levels], g[order].astype("<u8").tobytes(), counts[order].astype("<i8").tobytes(), holders[order].astype("<i8").tobytes()


def _unpacked(levels: list[bytes], fingerprints: bytes, counts: bytes, holders: bytes) -> Shard:
    return Shard(PerfectHash([np.frombuffer(x, "<u8") for x in levels]), np.frombuffer(fingerprints, "<u8"), np.frombuffer(counts, "<i8"), np.frombuffer(holders, "<i8"))


_SHARD = pa.schema([("shard", pa.int32()), ("levels", pa.list_(pa.binary())), ("fingerprints", pa.binary()), ("counts", pa.binary()), ("holders", pa.binary())])
_SHARD_DDL = "shard int, levels array<binary>, fingerprints binary, counts binary, holders binary"


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of arrays for each shard; the keys of a shard lie together."""
    held: list[pa.RecordBatch] = []

    def made() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        number = lambda n: rows.column(n).to_numpy()
        columns = _packed(number("h").view(np.uint64), number("g").view(np.uint64), number("docs"), number("holder"))
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((number("shard")[0], *columns), _SHARD, strict=True)], schema=_SHARD)

    for batch in batches:
        shards = batch.column("shard").to_numpy()
        bounds = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(shards)]
        for low, high in zip(bounds, bounds[1:], strict=False):
            if held and high > low and held[0].column("shard")[0].as_py() != shards[low]:
                yield made()
                held = []
            if high > low:
                held.append(batch.slice(low, high - low))
    if held:
        yield made()


class LineIndex(NamedTuple):
    """Rows of shards, their number, their bytes together, and the least key that was counted."""

    table: DataFrame
    shards: int
    bytes: int
    least_chars: int


def _keys(least_chars: int):
    """The different keys of each document."""
    schema = pa.schema([("doc", pa.int64()), ("h", pa.int64()), ("g", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident("lines", tuple)  # lets go of what other operators kept
        for batch in batches:
            for rows in chunks(column_rows(batch, ["doc_id", "text"]), 512):
                found = [np.unique(hashed(text, least_chars)[1], axis=0) for _, text in rows]
                both = np.concatenate(found).view(np.int64)
                docs = pa.array([doc for doc, _ in rows], pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), [len(x) for x in found])))
                yield pa.RecordBatch.from_arrays([docs, pa.array(both[:, 0]), pa.array(both[:, 1])], schema=schema)

    return run


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, shard_keys: int = SHARD_KEYS) -> LineIndex:
    """Counts the keys of a table and builds the shards of those that several documents have."""
    spark = docs.sparkSession
    each = narrow(docs, doc_id=F.col(f"`{id_col}`").cast("long"), text=F.col(f"`{text_col}`")).mapInArrow(_keys(least_chars), "doc long, h long, g long")
    by_doc = each.groupBy("h", "g", "doc").agg(F.lit(1).alias("one"))
    counted = by_doc.groupBy("h", "g").agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.max("doc"), F.lit(_NOBODY)).alias("holder")).filter("docs > 1")
    keys = scratch(counted, "line-keys")
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-keys.count() // shard_keys))
    dealt = keys.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int")).repartition(shards, "shard").sortWithinPartitions("shard")
    table = scratch(dealt.select("shard", "h", "g", "docs", "holder").mapInArrow(_build, _SHARD_DDL), "line-shards")
    release(keys)
    bits = F.aggregate("levels", F.lit(0), lambda n, x: n + F.length(x))
    size = table.agg(F.sum(F.length("fingerprints") + F.length("counts") + F.length("holders") + bits)).first()[0]
    return LineIndex(table, shards, size or 0, least_chars)


class Held:
    """All shards of an index."""

    def __init__(self, rows: list[tuple], shards: int):
        self.shards, self.opened = shards, {s: _unpacked(*arrays) for s, *arrays in rows}

    def doomed(self, hashes: np.ndarray, docs: np.ndarray, least: int) -> np.ndarray:
        gone = np.zeros(len(hashes), bool)
        shard = hashes[:, 0].view(np.int64) % self.shards
        order = np.argsort(shard, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            if len(part) and (one := self.opened.get(int(shard[part[0]]))) is not None:
                gone[part] = one.doomed(hashes[part, 0], hashes[part, 1], docs[part], least)
        return gone


def _probed_here(held: LineIndex, least_docs: int):
    """A function of id and text: the numbers of the lines that go, where each task has all shards."""
    rows = held.table.toArrow().to_pylist()  # BROADCAST_BYTES at most
    sent = held.table.sparkSession.sparkContext.broadcast([(r["shard"], r["levels"], r["fingerprints"], r["counts"], r["holders"]) for r in rows])
    token, shards, least_chars = uuid.uuid4().hex, held.shards, held.least_chars

    @F.pandas_udf("array<int>")
    def gone(doc_id: pd.Series, text: pd.Series) -> pd.Series:
        index_ = resident(("lines", token), lambda: Held(sent.value, shards))
        found = [hashed(t, least_chars) for t in text]
        sizes = [len(places) for places, _ in found]
        ids = np.repeat(np.array([_NOBODY if pd.isna(i) else int(i) for i in doc_id], np.int64), sizes)
        lost = index_.doomed(np.concatenate([x for _, x in found]) if found else np.zeros((0, 2), np.uint64), ids, least_docs)
        ends = np.cumsum(sizes)
        return pd.Series([np.array(places, np.int32)[lost[e - n : e]] for (places, _), n, e in zip(found, sizes, ends, strict=True)])

    return gone


_ASKED = "row string, doc long, at int, h long, g long"


def _requests(least_chars: int):
    schema = pa.schema([("row", pa.string()), ("doc", pa.int64()), ("at", pa.int32()), ("h", pa.int64()), ("g", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in chunks(column_rows(batch, ["row", "doc_id", "text"]), 512):
                out = []
                for row, doc, text in rows:
                    places, both = hashed(text, least_chars)
                    out += [(row, _NOBODY if doc is None else doc, at, *pair) for at, pair in zip(places, both.view(np.int64).tolist(), strict=True)]
                yield record_batch(out, schema)

    return run


def _answers(least_docs: int):
    schema = pa.schema([("row", pa.string()), ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = shard = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(n).to_numpy() for n in ("shard", "copy", "asks")])
            bounds = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for low, high in zip(bounds, bounds[1:], strict=False):
                part = batch.slice(low, high - low)
                if not keys[low, 2]:
                    name, shard = tuple(keys[low, :2]), _unpacked(*(part.column(n)[0].as_py() for n in ARRAYS))
                elif name == tuple(keys[low, :2]):
                    h, g, doc = (part.column(n).to_numpy() for n in ("h", "g", "doc"))
                    lost = pa.array(shard.doomed(h.view(np.uint64), g.view(np.uint64), doc, least_docs))
                    yield pa.RecordBatch.from_arrays([part.column(n).filter(lost) for n in ("row", "at")], schema=schema)

    return run


ARRAYS = {"levels": "array<binary>", "fingerprints": "binary", "counts": "binary", "holders": "binary"}


def _probed_apart(rows: DataFrame, held: LineIndex, least_docs: int, requests: int) -> DataFrame:
    """(row, gone): the rows (row, doc_id, text) that lose lines, and the numbers of these. What is
    asked for one row that occurs often is spread like all else, as any copy of a shard gives the answer."""
    spark = rows.sparkSession
    asked = rows.mapInArrow(_requests(held.least_chars), _ASKED).select(F.pmod("h", F.lit(held.shards)).cast("int").alias("shard"), "row", "doc", "at", "h", "g")
    asked = scratch(asked, "line-asked")
    copies = scratch(asked.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / requests).cast("int").alias("copies")), "line-copies")
    none = lambda kind: F.lit(None).cast(kind)
    shards = held.table.join(small_side(copies), "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("asks"), *ARRAYS,
        none("string").alias("row"), none("long").alias("doc"), none("int").alias("at"), none("long").alias("h"), none("long").alias("g"),
    )
    questions = asked.join(small_side(copies), "shard").select(
        "shard", F.pmod(F.monotonically_increasing_id(), F.col("copies")).cast("int").alias("copy"), F.lit(1).alias("asks"), *[none(t).alias(n) for n, t in ARRAYS.items()], "row", "doc", "at", "h", "g"
    )
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), held.shards)
    met = shards.unionByName(questions).repartition(tasks, "shard", "copy").sortWithinPartitions("shard", "copy", "asks")
    gone = scratch(met.mapInArrow(_answers(least_docs), "row string, at int").groupBy("row").agg(F.collect_set("at").alias("gone")), "line-gone")
    release(asked)
    return gone


def judged(docs: DataFrame, least_docs: int = LEAST_DOCS, least_chars: int = LEAST_CHARS, id_col: str = "doc_id", text_col: str = "text", held: LineIndex | None = None, broadcast_bytes: int = BROADCAST_BYTES, requests: int = REQUESTS) -> DataFrame:
    """(row, doc_id, text, gone) for each row of docs: all its columns as one, its id and text, and the
    numbers of the lines that go, from 0. `held` is an index made before, of this or another table."""
    held = held or index(docs, id_col, text_col, least_chars)
    packed = narrow(docs).select(F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    if held.bytes <= broadcast_bytes:
        return packed.withColumn("gone", _probed_here(held, least_docs)("doc_id", "text"))
    keyed = packed.withColumn("key", row_key(F.col("doc_id"), F.col("text")))  # rows equal in it lose the same lines
    gone = _probed_apart(keyed.select(F.col("key").alias("row"), "doc_id", "text"), held, least_docs, requests).withColumnRenamed("row", "lost")
    marked = maybe_in(keyed, F.col("key"), membership_filter(gone, F.col("lost")))
    empty, columns = F.array().cast("array<int>"), ["row", "doc_id", "text"]
    clear = marked.filter(~F.col("_maybe")).select(*columns, empty.alias("gone"))
    hit = marked.filter("_maybe").join(small_side(gone), F.col("key") == F.col("lost"), "left")
    return clear.unionByName(hit.select(*columns, F.coalesce("gone", empty).alias("gone")))


def kept_text(text: Column, gone: Column) -> Column:
    """text without the lines of these numbers."""
    left = F.array_join(F.filter(lines_of(text), lambda line, at: ~F.array_contains(gone, at)), "\n")
    return F.when(F.size(gone) > 0, left).otherwise(text)


def drop_lines(docs: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """docs with the lines dropped from the text; settings are those of judged."""
    found = judged(docs, text_col=text_col, **settings)
    return found.select(*[(kept_text(F.col("text"), F.col("gone")) if n == text_col else F.col("row").getField(n)).alias(n) for n in docs.columns])
