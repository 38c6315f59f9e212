"""What the corpus operators share: row access to Arrow batches, bounded tables of words,
and a fixed-size membership filter that keeps clean rows out of shuffles."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.storage import release, scratch

#: Bits of a membership filter for each key, and its bounds: 32 MB when broadcast, at any size of the
#: input. A fuller filter lets more rows through to the exact join behind it: time, never results.
KEY_BITS, LEAST_BITS, MOST_BITS = 32, 1 << 20, 1 << 28
_BUCKET_BITS = 8 * 4096  # what bitmap_construct_agg holds in one value


#: Bounds of an Arrow batch between the JVM and Python: texts are long, and both sides hold a batch.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def narrow(docs: DataFrame, **columns: Column) -> DataFrame:
    """The columns that go to Python, in small batches. The session keeps the batch size, as plans
    run after this returns."""
    conf = docs.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs.select(*[c.alias(n) for n, c in columns.items()]) if columns else docs


def column_rows(batch: pa.RecordBatch, names: list[str], step: int = 256) -> Iterator[tuple]:
    """Rows of the named columns as Python values, a few at a time."""
    columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
    for low in range(0, batch.num_rows, step):
        yield from zip(*(c.slice(low, step).to_pylist() for c in columns), strict=True)


class Remembered(dict):
    """A bounded table of what `make` gives for a key, in two generations: a full one becomes the
    old one, and keys asked for again come back from there. Keys over `longest` are not kept."""

    entries, longest = 500_000, 48

    def __init__(self):
        self.old: dict = {}

    def make(self, key: str):
        raise NotImplementedError

    def __missing__(self, key: str):
        if (value := self.old.get(key)) is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


_resident: dict = {}


def resident(key, build):
    """What `build` makes, kept for the tasks of this Python worker until another key is asked for:
    a worker that serves several operators holds the tables of one of them, and gives the memory of
    the others back to the system."""
    if key not in _resident:
        _resident.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
            trim(0)
        _resident[key] = build()
    return _resident[key]


def chunks(rows: Iterator, size: int) -> Iterator[list]:
    held: list = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield held
            held = []
    if held:
        yield held


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def bucket_of(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, mod 5: 0 marks held-out rows."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5, F.lit(1))


def row_key(doc_id: Column, text: Column) -> Column:
    """What names a row: its id and a digest of its text, so that rows that share an id, or have
    none, are told apart. Rows equal in both are one to every operator that asks for this key."""
    return F.concat(F.coalesce(doc_id.cast("long").cast("string"), F.lit("")), F.lit(":"), F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 24))


def key_id(key: Column) -> Column:
    """The id in a row_key, null where the row has none."""
    return F.split_part(key, F.lit(":"), F.lit(1)).try_cast("long")


def bounded_sample(rows: DataFrame, most_chars: int) -> list[tuple]:
    """(_text, _label) of rows (_id, _text, _label) that were cut to a bounded number of ids: one row
    for each id, the smallest, in the order of a hash of the id. The whole texts together have at most
    `most_chars` characters, which bounds what comes to the driver: a text that does not fit any more
    is left out, and those behind it that do are taken."""
    one = rows.groupBy("_id").agg(F.min(F.struct("_text", "_label")).alias("_row")).select("_id", "_row.*")
    settled = scratch(one.withColumn("_order", F.xxhash64("_id")), "sample")
    fits, left = [], most_chars
    for found, chars in settled.select("_id", F.length("_text").cast("long")).orderBy("_order", "_id").collect():  # as few as the ids
        if chars <= left:
            fits.append(found)
            left -= chars
    upto = settled.sparkSession.createDataFrame([(i,) for i in fits], "_id long")
    found = settled.join(F.broadcast(upto), "_id").select("_order", "_id", "_text", "_label").toArrow().sort_by([("_order", "ascending"), ("_id", "ascending")])
    release(settled)
    return list(zip(found.column("_text").to_pylist(), found.column("_label").to_pylist(), strict=True))


class Filter(NamedTuple):
    """A bitmap as rows (slot, bits) and the number of its bits."""

    bitmap: DataFrame
    size: int


def membership_filter(keys: DataFrame, key: Column) -> Filter:
    """A bitmap over the keys, with no false negatives; its size follows the count of the keys."""
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (KEY_BITS * keys.count()).bit_length()))
    at = F.pmod(F.xxhash64(key), F.lit(size))
    return Filter(
        keys.select(F.floor(at / _BUCKET_BITS).cast("long").alias("slot"), F.pmod(at, F.lit(_BUCKET_BITS)).alias("bit"))
        .groupBy("slot")
        .agg(F.bitmap_construct_agg("bit").alias("bits")),
        size,
    )


def maybe_in(rows: DataFrame, key: Column, known: Filter) -> DataFrame:
    """rows with a boolean `_maybe`: false means that the key is surely not in the filter."""
    marked = rows.withColumn("_at", F.pmod(F.xxhash64(key), F.lit(known.size)))
    slot = F.floor(F.col("_at") / _BUCKET_BITS).cast("long")
    joined = marked.join(F.broadcast(known.bitmap.withColumnRenamed("slot", "_slot").withColumnRenamed("bits", "_bits")), slot == F.col("_slot"), "left")
    bit = F.pmod(F.col("_at"), F.lit(_BUCKET_BITS))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(byte.bitwiseAND(F.expr(f"shiftleft(1, cast(pmod(_at, {_BUCKET_BITS}) % 8 as int))")) != 0, F.lit(False))
    return joined.withColumn("_maybe", hit).drop("_at", "_slot", "_bits")


#: Rows of a narrow side (keys of some dozen bytes) up to which it is broadcast after being counted;
#: beyond, the join is left to shuffle.
BROADCAST_ROWS = 100_000


def small_side(side: DataFrame) -> DataFrame:
    """side, to be broadcast if it is counted to have BROADCAST_ROWS at most."""
    return F.broadcast(side) if side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else side


def keep_rows_not_in(docs: DataFrame, key: Column, dropped: DataFrame, dropped_key: str) -> DataFrame:
    """docs without the rows whose key is in `dropped`, columns and repeated rows as they are.
    Rows that the filter clears pass without a shuffle; only the few others meet the anti-join."""
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row"), key.alias("_key"))
    marked = maybe_in(packed, F.col("_key"), membership_filter(dropped, F.col(dropped_key)))
    clear = marked.filter(~F.col("_maybe")).select("_row")
    unclear = marked.filter(F.col("_maybe")).join(small_side(dropped.select(F.col(dropped_key).alias("_drop"))), F.col("_key") == F.col("_drop"), "left_anti").select("_row")
    return clear.unionByName(unclear).select(*[F.col("_row").getField(n).alias(n) for n in names])
